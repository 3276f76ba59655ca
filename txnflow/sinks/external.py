"""Topic and database sinks through Spark's own connectors.

They need the Kafka connector or the database driver on the class path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from txnflow.operators.messages import encode_keyed_message, encode_message


def keyed_messages(df: DataFrame, key: str | None) -> DataFrame:
    """The messages of all rows; rows that lack the key are an error, not left out."""
    if key is None:
        return encode_message(df)
    messages, refused = encode_keyed_message(df, key)
    if not refused.isEmpty():
        raise ValueError(f"rows without a value in the key column {key!r}")
    return messages


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    messages = keyed_messages(df, key)
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def jdbc_options(host: str, port: int, database: str, table: str, user: str, password: str) -> dict[str, str]:
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "driver": "org.postgresql.Driver",
        "dbtable": table,
        "user": user,
        "password": password,
    }


def write_jdbc_append(df: DataFrame, options: Mapping[str, str]) -> None:
    """Append; every partition opens one connection, so the count is bounded by the options."""
    df.write.format("jdbc").options(**options).mode("append").save()
