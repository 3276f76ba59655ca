"""Declared constraints as predicates and violation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.schema import ID_COLUMNS, MAX_LENGTHS, RANGES, REQUIRED
from txnflow.session import all_of, stored


def in_range(ranges: Mapping[str, tuple[float, float]] = RANGES) -> Column:
    """A NULL passes, as in a CHECK."""
    return all_of([F.coalesce(F.col(c).between(low, high), F.lit(True)) for c, (low, high) in ranges.items()])


def not_null(cols: Sequence[str] = tuple(REQUIRED)) -> Column:
    return all_of([F.col(c).isNotNull() for c in cols])


def fits_length(limits: Mapping[str, int] = MAX_LENGTHS) -> Column:
    return all_of([F.coalesce(F.length(c) <= n, F.lit(True)) for c, n in limits.items()])


def violations() -> Column:
    """Names of the violated constraints of a staging row, in a fixed order."""
    marks = [F.when(~in_range({c: r}), f"range:{c}") for c, r in RANGES.items()]
    marks += [F.when(F.col(c).isNull(), f"null:{c}") for c in [*REQUIRED, *ID_COLUMNS]]
    marks += [F.when(~fits_length({c: n}), f"length:{c}") for c, n in MAX_LENGTHS.items()]
    return F.array_compact(F.array(*marks))


def acceptable() -> Column:
    return in_range() & not_null([*REQUIRED, *ID_COLUMNS]) & fits_length()


def check_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = RANGES) -> DataFrame:
    return df.filter(~in_range(ranges))


def check_not_null(df: DataFrame, cols: Sequence[str] = tuple(REQUIRED)) -> DataFrame:
    return df.filter(~not_null(cols))


def check_length(df: DataFrame, limits: Mapping[str, int] = MAX_LENGTHS) -> DataFrame:
    return df.filter(~fits_length(limits))


def check_unique(df: DataFrame, keys: Sequence[str], count_as: str = "n") -> DataFrame:
    """Keys that occur more than once; NULL equals nothing in a UNIQUE key."""
    return (
        df.filter(not_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)
    )


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame) -> DataFrame:
    """Distinct foreign keys without a parent.

    The keys are made distinct before the join, so a key that holds a third of
    the child rows takes part once.
    """
    keys = child.select(fk).filter(F.col(fk).isNotNull()).distinct()
    return keys.join(parent.select(F.col("id").alias(fk)), fk, "left_anti")


def check_reference(child: DataFrame, fk: str, parent: DataFrame) -> DataFrame:
    """Child rows whose foreign key has no parent.

    The orphan keys are stored; Spark broadcasts a set of few bytes, so that
    the child is not shuffled at all, and joins a large one by shuffle, where
    AQE splits hot keys.
    """
    return child.join(stored(orphan_keys(child, fk, parent)), fk, "left_semi").select(*child.columns)
