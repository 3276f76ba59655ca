"""Deterministic name-based ids (UUID version 5) without a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The OID namespace of RFC 4122 as bytes, the prefix put before
# every name, and the text a missing name is given in parity mode.
OID_NAMESPACE_HEX = "6ba7b8129dad11d180b400c04fd430c8"
NAME_PREFIX = "something:"
NULL_NAME = "None"


def uuid5_oid(name: Column, null_as_text: bool = False) -> Column:
    """UUIDv5 of the prefixed name. NULL stays NULL unless ``null_as_text``."""
    if null_as_text:
        name = F.coalesce(name, F.lit(NULL_NAME))
    digest = F.sha1(
        F.concat(
            F.unhex(F.lit(OID_NAMESPACE_HEX)),
            F.concat(F.lit(NAME_PREFIX), name).cast("binary"),
        )
    )
    # RFC 4122: version nibble 5, two variant bits 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    dash = F.lit("-")
    return F.concat(
        F.substring(digest, 1, 8),
        dash,
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        dash,
        variant,
        F.substring(digest, 18, 3),
        dash,
        F.substring(digest, 21, 12),
    )


def joined(parts: Sequence[Column], sep: str | None = None) -> Column:
    """NULL-propagating concatenation.

    Without a separator ("ab","c") and ("a","bc") give the same text, and so
    the same id; a separator keeps them apart.
    """
    if sep is None:
        return F.concat(*parts)
    spaced: list[Column] = []
    for part in parts:
        if spaced:
            spaced.append(F.lit(sep))
        spaced.append(part)
    return F.concat(*spaced)


def timestamp_text(ts: Column) -> Column:
    """The whole timestamp, fractions of a second included."""
    return ts.cast("string")


def amount_text(amount: Column) -> Column:
    """The shortest text that gives the same double; any amount has one, infinity and NaN too."""
    return amount.cast("string")


_SQL_BODY = """
  lower(concat(
    substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 1, 8), '-',
    substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 9, 4), '-5',
    substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 14, 3), '-',
    translate(substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 17, 1),
              '0123456789abcdef', '89ab89ab89ab89ab'),
    substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 18, 3), '-',
    substr(sha1(X'{ns}' || cast('{prefix}' || {arg} as binary)), 21, 12)))
"""


def register_sql_functions(spark: SparkSession) -> None:
    """Make the id function callable from SQL text, still without Python.

    ``uuid5_oid`` keeps NULL; ``create_deterministic_uuid`` maps every NULL to
    one constant id.
    """
    variants = {
        "uuid5_oid": "s",
        "create_deterministic_uuid": f"coalesce(s, '{NULL_NAME}')",
    }
    for name, arg in variants.items():
        body = _SQL_BODY.format(ns=OID_NAMESPACE_HEX, prefix=NAME_PREFIX, arg=arg)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN {body}")
