"""Profiling: counts, frequencies, duplicates, dependencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.operators.constraints import check_unique
from txnflow.session import stored


def distinct_counts(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, NULL not counted: one row per column.

    Exact counting expands every row once per column, but only distinct
    (column, value) pairs leave a task. ``approximate`` keeps one sketch per
    column and shuffles no values.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(F.col(c)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "n_distinct")


#: Logarithm of the registers of a sketch; the standard error is about 1.04 / sqrt(2^LOG_REGISTERS), 1.6 %.
LOG_REGISTERS = 12


def distinct_sketches(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, sketch): one mergeable sketch of the distinct values of each column, some KB whatever the rows."""
    wide = df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_REGISTERS)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "sketch")


def distinct_from_sketches(sketches: DataFrame) -> DataFrame:
    """Distinct values per column over all loads, from their stored sketches; the rows are not read again."""
    merged = sketches.where("sketch is not null").groupBy("column_name").agg(F.hll_union_agg("sketch").alias("all"))
    return merged.select("column_name", F.hll_sketch_estimate("all").alias("n_distinct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(col))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once.

    The repeated keys are counted with map-side combine and stored. Spark
    broadcasts a set of few bytes, and the rows stay where they are; a large
    one is joined by shuffle, where AQE splits hot keys. NULL keys are equal to each other.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = stored(counted.select(*[F.col(k).alias(f"_{k}") for k in keys]))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(repeated, same, "left_semi")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def profile(df: DataFrame) -> DataFrame:
    """Type and non-NULL count per column."""
    types = F.create_map(*[F.lit(x) for name, dtype in df.dtypes for x in (name, dtype)])
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_filled").withColumn("dtype", types[F.col("column_name")])


def functional_dependency(df: DataFrame, lhs: Sequence[str], rhs: str) -> DataFrame:
    """Keys under which ``rhs`` takes more than one value: none if lhs determines it.

    Distinct pairs first, so a hot key costs as much as it has values.
    """
    pairs = df.select(*lhs, rhs).filter(F.col(rhs).isNotNull()).distinct()
    return check_unique(pairs, lhs, "n_values")
