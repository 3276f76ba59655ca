"""Session settings the engine depends on, and its shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# masters whose tasks all run in this process
_ONE_PROCESS = re.compile(r"local(\[.*\])?")

# application id -> folder, where the session names none
_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on.

    Transaction ids contain a printed timestamp, so they change with the zone.
    Repeated JSON members are legal input (the last one wins). HotSpot leaves
    methods above 8000 bytes of bytecode uncompiled, so generated stages of that
    size (the validation of 22 fields) are better split by expression. Ids are
    hex digits, which need half the space in files that are entropy coded.
    Shuffle files of an ended query go at once, not when the driver happens to
    collect its garbage: results that are read again are stored.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC"):
        raise ValueError(f"session time zone must be UTC, not {zone}: transaction ids depend on it")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only where the cluster names none (tests, one machine) is a local
    temporary folder made and kept for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not _ONE_PROCESS.fullmatch(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        root = _local_roots.get(app) or tempfile.mkdtemp(prefix="txnflow-")
        _local_roots[app] = root
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later steps read stored rows, not the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(new_folder(spark, "checkpoint"))
    return df.checkpoint()


def stored(df: DataFrame, label: str = "keys") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Computed once, and of known size: a join with it is broadcast or shuffled
    by Spark's own byte threshold.
    """
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def together(spark: SparkSession, calls: Sequence[Callable[[], Any]]) -> list[Any]:
    """The results of calls that do not need each other; their Spark jobs run side by side."""
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        return [r.result() for r in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]


def all_of(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
