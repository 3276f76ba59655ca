"""One batch of records into the stored model, safe to repeat."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.operators.constraints import acceptable, violations
from txnflow.operators.normalise import load_tables, with_audit
from txnflow.operators.project import to_staging
from txnflow.schema import TABLES
from txnflow.session import stored as store
from txnflow.session import together
from txnflow.sources.snapshots import Snapshot, current
from txnflow.sources.tables import (
    BY_MONTH,
    MONTH,
    ORPHANS,
    Months,
    create_tables,
    month_of,
    near_facts,
    scan_staging,
    stored_before,
    write_index,
)


def write_staging(records: DataFrame, root: str, load_id: str, **id_options) -> None:
    """Add ids, check the constraints, store. Refused rows carry their reasons."""
    rows = to_staging(records, **id_options).withColumn("violated", F.when(~acceptable(), violations()))
    rows.write.mode("overwrite").parquet(f"{root}/staging/load_id={load_id}")


def write_delta(name: str, delta: DataFrame, root: str, load_id: str, snapshot: Snapshot) -> None:
    """Overwrite this load's own partition of one table."""
    rows = with_audit(delta)
    target = f"{snapshot.folder(root, name)}/load_id={load_id}"
    if name in BY_MONTH:
        # rows of a month meet in few files; AQE splits a month that is too big for one
        rows = rows.withColumn(MONTH.name, month_of(F.col("transaction_ts"))).hint("rebalance", MONTH.name)
        rows.write.mode("overwrite").partitionBy(MONTH.name).parquet(target)
    else:
        rows.write.mode("overwrite").parquet(target)


def write_orphans(orphans: DataFrame, root: str, load_id: str, snapshot: Snapshot) -> None:
    """Overwrite this load's staging rows whose customer was refused."""
    orphans.write.mode("overwrite").parquet(f"{snapshot.folder(root, ORPHANS)}/load_id={load_id}")


def _months(staging: DataFrame) -> Months:
    """The months of a batch, one number for each."""
    months = staging.select(month_of(F.col("transaction_ts")).alias("ym")).where("ym is not null").distinct()
    return sorted(r["ym"] for r in months.collect())


def load_staged(
    spark: SparkSession, root: str, load_id: str, mode: str = "complete", grain: str = "batch"
) -> None:
    """Load the stored staging rows of one load, parents first."""
    staging = scan_staging(spark, root, load_id)
    months = _months(staging)
    if not months:
        return
    now = current(spark, root)
    stored = stored_before(spark, root, load_id, months, now, [n for n in TABLES if n != "transactions"])
    incoming = staging.select("id", month_of(F.col("transaction_ts")).alias(MONTH.name)).where("id is not null")
    near = near_facts(spark, root, load_id, incoming, months, now)
    # a stored set: of known size, so where it is small the facts of the batch are not shuffled to meet it
    stored["transactions"] = store(near.select("id"), "near")
    new = load_tables(staging, stored, mode, grain)
    # one after the other, these small writes took longer than the rows do
    together(spark, [partial(write_delta, name, new[name], root, load_id, now) for name in TABLES if name not in BY_MONTH])
    for name in BY_MONTH:
        write_delta(name, new[name], root, load_id, now)
    write_index(spark, root, load_id, now)
    if "orphans" in new:
        write_orphans(new["orphans"], root, load_id, now)


def load_batch(
    records: DataFrame, root: str, load_id: str, mode: str = "complete", grain: str = "batch", **id_options
) -> None:
    """Typed records to staging to the seven tables."""
    spark = records.sparkSession
    create_tables(spark, root)
    write_staging(records, root, load_id, **id_options)
    load_staged(spark, root, load_id, mode, grain)
