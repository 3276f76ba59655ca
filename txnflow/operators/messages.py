"""Rows as messages for a topic, and the audit of what arrived there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.functions.text import millis_text


def encode_message(df: DataFrame) -> DataFrame:
    """One JSON text per row, no key."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def encode_keyed_message(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(messages, refused): the key column leaves the payload and becomes the key.

    A column that does not exist is an error; rows with a NULL key are refused.
    """
    if key not in df.columns:
        raise ValueError(f"no column {key!r} in the payload")
    rest = [c for c in df.columns if c != key]
    keyed = df.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rest)).alias("value")
    )
    return keyed, df.filter(F.col(key).isNull())


def delivery_report(df: DataFrame) -> DataFrame:
    """One line per delivered message, the time as text."""
    return df.select(
        "topic",
        F.col("partition").alias("topic_partition"),
        F.col("offset").alias("kafka_offset"),
        "latency",
        millis_text(F.col("timestamp_ms")).alias("produce_kafka_time"),
    )


def delivery_audit(df: DataFrame) -> DataFrame:
    """Per topic and partition: messages, highest offset, mean latency, last time."""
    return df.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.max("offset").alias("last_offset"),
        F.avg("latency").alias("avg_latency"),
        millis_text(F.max("timestamp_ms")).alias("last_time"),
    )
