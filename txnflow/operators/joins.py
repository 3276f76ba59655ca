"""Joins of the loader. All but one only filter, so they are semi or anti joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.schema import TABLES


def known_only(rows: DataFrame, fk: str, parent: DataFrame) -> DataFrame:
    """Rows whose ``fk`` is stored in ``parent``."""
    ids = parent.select(F.col("id").alias(fk))
    return rows.join(ids, fk, "left_semi")


def not_stored(rows: DataFrame, id_col: str, stored: DataFrame) -> DataFrame:
    """Rows whose id is not stored yet; a NULL id is neither stored nor new."""
    ids = stored.select(F.col("id").alias(id_col))
    return rows.filter(F.col(id_col).isNotNull()).join(ids, id_col, "left_anti")


def gated_by(rows: DataFrame, **deltas: DataFrame) -> DataFrame:
    """Rows whose foreign keys are all among the rows new in this load."""
    for fk, delta in deltas.items():
        rows = known_only(rows, fk, delta)
    return rows


def denormalise(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rebuild the wide staging row over the key graph.

    The dimensions are joined with each other first, so the fact meets two wide
    dimensions instead of six narrow ones.
    """

    def prefixed(name: str) -> DataFrame:
        return tables[name].select(*[F.col(dst).alias(src) for dst, src in TABLES[name].columns.items()])

    buyer = prefixed("customer").join(prefixed("address").join(prefixed("city"), "city_id"), "address_id")
    seller = (
        prefixed("merchant_category").join(prefixed("category"), "category_id").join(prefixed("merchant"), "merchant_id")
    )
    return prefixed("transactions").join(seller, "merchant_category_id").join(buyer, "customer_id")
