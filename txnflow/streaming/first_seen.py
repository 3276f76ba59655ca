"""First-seen rows with state kept by the engine, bounded by a watermark.

The table-backed variant (``insert_ignore`` in ``load_batch``) compares with
everything stored. This one remembers a key for ``delay`` after its event time:
a repeat within that time is dropped, a row older than the watermark is late
and dropped too, and state behind the watermark is removed. State lies in
RocksDB on the executors' disks and is checkpointed, so it may outgrow memory
and a restart goes on from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txnflow.streaming.start import DEFAULT_INTERVAL, run_name, start_sink

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession, count_rows: bool = True) -> None:
    """Streams started from now on keep their state in RocksDB, and what a batch changes as a log.

    Progress reports tell the rows of the state if ``count_rows``; every write
    then looks its key up once more.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", str(count_rows).lower())
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def first_seen(rows: DataFrame, keys: Sequence[str], at: str, delay: str) -> DataFrame:
    """The first row of each key; ``at`` is the event time, ``delay`` how late a row or its repeat may come."""
    return rows.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def start_first_seen(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    at: str,
    delay: str,
    interval: str | None = DEFAULT_INTERVAL,
    count_rows: bool = True,
) -> StreamingQuery:
    """Store first-seen rows under ``root``; a repeated micro-batch replaces its own folder."""
    keep_state_on_disk(rows.sparkSession, count_rows)
    run = run_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/load_id={run}-{batch_id}")

    return start_sink(first_seen(rows, keys, at, delay), write, checkpoint, interval, output_mode="append")
