"""Topic source. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# How a topic is read unless told otherwise.
DEFAULT_OPTIONS: dict[str, str] = {
    "includeHeaders": "true",
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}


def kafka_options(servers: str, topic: str, max_offsets: int | None = None, **more: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **DEFAULT_OPTIONS}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return {**options, **more}


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of framed messages: key, value, topic, partition, offset, timestamp, headers."""
    return spark.readStream.format("kafka").options(**options).load()
