"""Projections: ids, the staging row, the entities, column selection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.functions.ids import amount_text, joined, timestamp_text, uuid5_oid
from txnflow.functions.text import iso_date, zip_text
from txnflow.schema import STAGING_COLUMNS, TABLES
from txnflow.session import require_utc


def create_id_cols(records: DataFrame, sep: str | None = None, null_as_text: bool = False) -> DataFrame:
    """Add the seven id columns in one projection.

    Ids are pure functions of the record, so no later step needs a join to look
    one up. The city id is plain text.
    """
    require_utc(records.sparkSession)

    def hashed(*parts):
        return uuid5_oid(joined(parts, sep), null_as_text)

    c = F.col
    return records.withColumns(
        {
            "city_id": joined([c("city"), c("state")], sep),
            "address_id": hashed(c("street")),
            "customer_id": hashed(c("first"), c("last"), c("dob"), c("cc_num")),
            "merchant_id": hashed(c("merchant")),
            "category_id": hashed(c("category")),
            "merchant_category_id": hashed(c("merchant"), c("category")),
            "transaction_id": hashed(c("trans_num"), timestamp_text(c("trans_date_trans_time")), amount_text(c("amt"))),
        }
    )


def choose_cols(with_ids: DataFrame) -> DataFrame:
    """The 25 staging columns under their table names."""
    typed = {"birth_date": iso_date, "zip": zip_text}
    return with_ids.select(
        *[typed.get(new, lambda col: col)(F.col(old)).alias(new) for new, old in STAGING_COLUMNS]
    )


def to_staging(records: DataFrame, **id_options) -> DataFrame:
    return choose_cols(create_id_cols(records, **id_options))


def project_entity(staging: DataFrame, name: str, *extra: str) -> DataFrame:
    """The columns of one table, taken from staging rows."""
    return staging.select(*[F.col(src).alias(dst) for dst, src in TABLES[name].columns.items()], *extra)


def columns_used(definitions: Mapping[str, Mapping[str, str]] | None = None) -> list[str]:
    """Source columns used by any table, each once."""
    if definitions is None:
        definitions = {name: {src: dst for dst, src in t.columns.items()} for name, t in TABLES.items()}
    return list(dict.fromkeys(col for mapping in definitions.values() for col in mapping))


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def drop_leading(df: DataFrame, n: int = 1) -> DataFrame:
    return df.select(df.columns[n:])


def select_remaining(df: DataFrame, used: Iterable[str]) -> DataFrame:
    gone = set(used)
    return df.select([c for c in df.columns if c not in gone])


def select_keep(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.select(*cols)
