"""Sort, head, tail and row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.session import cut

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def _ascending(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Keys first, then all other columns, so that equal keys do not form one range."""
    rest = [c for c in df.columns if c not in keys]
    return [F.col(c).asc_nulls_last() for c in [*keys, *rest]]


def _descending(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    rest = [c for c in df.columns if c not in keys]
    return [F.col(c).desc_nulls_first() for c in [*keys, *rest]]


def sort(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*_ascending(df, keys))


def head(df: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """First n rows; with keys a top-n that keeps only n rows per task."""
    return (sort(df, keys) if keys else df).limit(n)


def tail(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Last n rows, in ascending order."""
    return sort(df.orderBy(*_descending(df, keys)).limit(n), keys)


def renumber(df: DataFrame, keys: Sequence[str], name: str = "row_no") -> DataFrame:
    """0-based position in key order, without gathering the rows in one task.

    Rows are range partitioned and sorted once and stored, which fixes who sits
    where. A row's number is its position in its partition plus the rows before
    that partition; only one count per partition is summed up globally. Copies
    of one row are spread over several ranges by a last, arbitrary key.
    """
    id_name = "_position"
    spread = df.withColumn("_copy", F.monotonically_increasing_id())
    order = [*_ascending(df, keys), F.col("_copy")]
    ranged = cut(spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy"))
    placed = ranged.withColumn(id_name, F.monotonically_increasing_id())
    part = F.shiftright(id_name, _POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the number of partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    position = F.col(id_name).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return numbered.select((F.col("_before") + position).alias(name), *df.columns)
