"""The stored model: one folder per table, one partition per loaded batch.

``<root>/<table>/load_id=<load>[/ym=<month>]``. A batch writes only its own
``load_id`` partitions, with overwrite, so running it again replaces what it
wrote before and touches nothing else. Facts are also partitioned by month: a
transaction id contains the timestamp, so a batch is compared with the stored
facts of its own months only, and of those only with the ones that the index of
stored ids cannot rule out. ``compact`` folds loads into segments; which folders
are read is said by the newest snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.schema import RECORD_SCHEMA, STAGING_COLUMNS, TABLES
from txnflow.session import stored
from txnflow.sources import fact_index
from txnflow.sources.snapshots import Snapshot, commit, current, next_snapshot, open_model, read_parts, segment_folder

_RECORD_TYPES = {f.name: f.dataType for f in RECORD_SCHEMA.fields}
_RETYPED = {"birth_date": T.DateType(), "zip": T.StringType()}

STAGING_SCHEMA = T.StructType(
    [
        T.StructField(name, _RETYPED.get(name, _RECORD_TYPES.get(source, T.StringType())), True)
        for name, source in STAGING_COLUMNS
    ]
)
_STAGING_TYPES = {f.name: f.dataType for f in STAGING_SCHEMA.fields}

AUDIT = [T.StructField("created_at", T.TimestampType(), True), T.StructField("updated_at", T.TimestampType(), True)]
LOAD = T.StructField("load_id", T.StringType(), True)
MONTH = T.StructField("ym", T.IntegerType(), True)

BY_MONTH = ("transactions",)
#: Beside the tables: staging rows of refused customers.
ORPHANS = "orphans"

#: Months as yyyymm numbers.
Months = list[int]


def table_schema(name: str) -> T.StructType:
    fields = [T.StructField(dst, _STAGING_TYPES[src], True) for dst, src in TABLES[name].columns.items()]
    return T.StructType([*fields, *AUDIT, LOAD, *([MONTH] if name in BY_MONTH else [])])


def month_of(ts: Column) -> Column:
    return F.year(ts) * 100 + F.month(ts)


# application id and root of the tables this process has made or found
_present: set[tuple[str, str]] = set()

#: Segments of one level that are merged into one of the next.
FAN = 4


def create_tables(spark: SparkSession, root: str) -> None:
    """Make empty tables where there are none; looked at once for each root."""
    key = (spark.sparkContext.applicationId, root)
    if key in _present:
        return
    open_model(spark, root)
    _create_generation(spark, root, current(spark, root))
    _present.add(key)


def _plain(name: str) -> T.StructType:
    """The columns that the files of a load hold."""
    return T.StructType([f for f in _schema(name).fields if f not in (LOAD, MONTH)])


def _schema(name: str) -> T.StructType:
    if name == ORPHANS:
        return T.StructType([*STAGING_SCHEMA.fields, LOAD])
    if name == fact_index.NAME:
        return T.StructType([*fact_index.SCHEMA.fields, LOAD])
    return table_schema(name)


def _create_generation(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    for name in (*TABLES, ORPHANS, fact_index.NAME):
        folder = f"{snapshot.folder(root, name)}/load_id=none" + ("/ym=0" if name in BY_MONTH else "")
        spark.createDataFrame([], _plain(name)).write.mode("ignore").parquet(folder)


def _loads(spark: SparkSession, root: str, snapshot: Snapshot, name: str) -> DataFrame:
    """Rows of the current generation."""
    return spark.read.schema(_schema(name)).parquet(snapshot.folder(root, name))


def _folded(spark: SparkSession, root: str, snapshot: Snapshot, name: str) -> DataFrame | None:
    """Rows of the live segments, if there are any."""
    live = [s for s, _ in snapshot.segments]
    return read_parts(spark, root, name, _schema(name), live) if live else None


def _both(loads: DataFrame, folded: DataFrame | None) -> DataFrame:
    return loads if folded is None else loads.unionByName(folded)


def _of_months(df: DataFrame, name: str, months: Months | None) -> DataFrame:
    return df if months is None or name not in BY_MONTH else df.filter(F.col(MONTH.name).isin(months))


def read_table(
    spark: SparkSession, root: str, name: str, months: Months | None = None, snapshot: Snapshot | None = None
) -> DataFrame:
    """One table of the newest snapshot, or of a given one."""
    now = snapshot or current(spark, root)
    return _of_months(_both(_loads(spark, root, now, name), _folded(spark, root, now, name)), name, months)


def stored_before(
    spark: SparkSession,
    root: str,
    load_id: str,
    months: Months | None = None,
    snapshot: Snapshot | None = None,
    names: Sequence[str] = tuple(TABLES),
) -> dict[str, DataFrame]:
    """All tables, or those of some names, without what this load itself wrote in an earlier attempt.

    What was folded since counts as stored: a repeated load adds nothing to it.
    The folders of a table are listed here, so only tables that are needed should be named.
    """
    now = snapshot or current(spark, root)
    out = {}
    for name in names:
        loads = _loads(spark, root, now, name).filter(F.col("load_id") != load_id)
        rows = _of_months(_both(loads, _folded(spark, root, now, name)), name, months)
        out[name] = rows.select(*TABLES[name].columns)
    return out


def stored_index(
    spark: SparkSession, root: str, load_id: str, months: Months, snapshot: Snapshot | None = None
) -> DataFrame:
    """The index of the stored fact ids of some months, without this load's own; ``part`` tells its parts apart."""
    now = snapshot or current(spark, root)
    name = fact_index.NAME
    loads = _loads(spark, root, now, name).filter(F.col("load_id") != load_id)
    return _both(loads, _folded(spark, root, now, name)).filter(F.col("ym").isin(months)).withColumnRenamed("load_id", "part")


def near_facts(
    spark: SparkSession, root: str, load_id: str, incoming: DataFrame, months: Months, snapshot: Snapshot | None = None
) -> DataFrame:
    """The stored facts that incoming facts (id, ym) may be equal to.

    The index is asked first. Where it rules out every id no fact is read or listed;
    otherwise the ids it leaves are stored, and where they are few Spark
    broadcasts them into a scan of the months' facts, which are not shuffled.
    """
    now = snapshot or current(spark, root)
    maybe = stored(fact_index.maybe_stored(incoming, stored_index(spark, root, load_id, months, now)), "maybe")
    if maybe.isEmpty():
        # rows the optimizer knows to be none, so the join with them goes, and its shuffle of the incoming facts
        fields = [F.lit(None).cast(_STAGING_TYPES[src]).alias(dst) for dst, src in TABLES["transactions"].columns.items()]
        return spark.range(1).limit(0).select(*fields)
    facts = stored_before(spark, root, load_id, months, now, ["transactions"])["transactions"]
    return facts.join(maybe, "id", "left_semi")


def write_index(spark: SparkSession, root: str, load_id: str, snapshot: Snapshot | None = None) -> None:
    """Index the facts that a load has written."""
    now = snapshot or current(spark, root)
    # only this load's own folder is listed
    base = now.folder(root, "transactions")
    facts = spark.read.schema("id string, ym int").parquet(f"{base}/load_id={load_id}")
    target = f"{now.folder(root, fact_index.NAME)}/load_id={load_id}"
    fact_index.build(facts).write.mode("overwrite").parquet(target)


def compact(spark: SparkSession, root: str, fan: int = FAN) -> Snapshot:
    """Fold the loads of the current generation into one segment of each table; returns the new snapshot.

    Everything is written before the snapshot is committed: a failure on the
    way leaves the old one in force, and folding again starts anew. Fact ids
    are indexed again, so an id is asked for once a segment.
    """
    now = current(spark, root)
    new, merged = next_snapshot(now, fan)
    segment = new.segments[-1][0]
    for name in (*TABLES, ORPHANS):
        rows = _loads(spark, root, now, name)
        if merged:
            rows = rows.unionByName(read_parts(spark, root, name, _schema(name), merged))
        target = segment_folder(root, name, segment)
        if name in BY_MONTH:
            rows.hint("rebalance", MONTH.name).write.mode("overwrite").partitionBy(MONTH.name).parquet(target)
        else:
            rows.hint("rebalance").write.mode("overwrite").parquet(target)
    facts = spark.read.schema("id string, ym int").parquet(segment_folder(root, "transactions", segment))
    index = fact_index.build(facts).withColumn("load_id", F.lit(segment))
    index.write.mode("overwrite").parquet(segment_folder(root, fact_index.NAME, segment))
    _create_generation(spark, root, new)
    commit(spark, root, new)
    return new


def scan_staging(spark: SparkSession, root: str, load_id: str | None = None, accepted: bool = True) -> DataFrame:
    """Staging rows, of one load if named; the refused ones with their reasons if not ``accepted``.

    Of a named load only its own folder is listed.
    """
    violated = T.StructField("violated", T.ArrayType(T.StringType()), True)
    reader = spark.read.schema(T.StructType([*STAGING_SCHEMA.fields, violated, LOAD])).option("basePath", f"{root}/staging")
    df = reader.parquet(f"{root}/staging" + ("" if load_id is None else f"/load_id={load_id}"))
    kept = F.col("violated").isNull()
    return df.filter(kept).select(*STAGING_SCHEMA.names) if accepted else df.filter(~kept).drop("load_id")


def scan_orphans(spark: SparkSession, root: str, load_id: str | None = None) -> DataFrame:
    """Staging rows whose customer was refused, with their load; of one load if named.

    A load that was folded and then repeated is read from its segment.
    """
    now = current(spark, root)
    loads, folded = _loads(spark, root, now, ORPHANS), _folded(spark, root, now, ORPHANS)
    if folded is not None:
        loads = loads.join(folded.select("load_id").distinct(), "load_id", "left_anti").select(*loads.columns)
    df = _both(loads, folded)
    return df if load_id is None else df.filter(F.col("load_id") == load_id)


def scan_ids(table: DataFrame) -> DataFrame:
    return table.select("id")
