"""Helpers the text operators share: exact ASCII lower case, stored tables, word arrays."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.session import new_folder

#: White space of the contracts, as a character class and as characters.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Words between white space, and words of letters, digits and all non-ASCII.
SPACED_WORD = rf"[^{SPACE_CLASS}]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is exact on ASCII texts and far cheaper than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text column, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_struct(names: list[str]) -> Column:
    """The named columns packed into one struct: there they cannot clash with an operator's inner names."""
    return F.struct(*(column(n) for n in names))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, no lineage."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def same_row(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of ``keys``."""
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out
