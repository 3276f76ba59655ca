"""Small scalar helpers: text, dates, JSON, object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Microseconds of a timestamp fit into 64 bits up to here.
MAX_UNIX_SECONDS = 9_223_372_036_854

def comma_pair(a: Column, b: Column) -> Column:
    """``a, b`` as text: coordinates, full names."""
    return F.concat(a.cast("string"), F.lit(", "), b.cast("string"))


def drop_prefix(c: Column, n: int) -> Column:
    return F.substring(c, n + 1, 2147483647)


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd to a date; anything else is NULL, also under ANSI mode."""
    return F.try_to_date(c, "yyyy-MM-dd")


def unix_to_ts(c: Column) -> Column:
    """NULL for what is no whole number, or beyond the range of a timestamp."""
    seconds = c.try_cast("bigint")
    return F.when(F.abs(seconds) < MAX_UNIX_SECONDS, F.timestamp_seconds(seconds))


def millis_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def object_path(trans_num: Column, at: Column, double_slash: bool = False) -> Column:
    """``/<yyyyMMdd>/<HH>00/<trans_num>.txt``; the parity flag doubles the last slash."""
    tail = "//" if double_slash else "/"
    return F.concat(
        F.lit("/"),
        F.date_format(at, "yyyyMMdd/HH"),
        F.lit("00" + tail),
        # a record without a number is still stored, under this name
        F.coalesce(trans_num, F.lit("None")),
        F.lit(".txt"),
    )


def json_field(value: Column, name: str) -> Column:
    return F.get_json_object(value, f"$.{name}")


def utf8_length(c: Column) -> Column:
    return F.octet_length(F.encode(c, "UTF-8"))


def zip_text(c: Column, pad: bool = False) -> Column:
    text = c.cast("string")
    # codes above five digits must stay visible to the length check
    return F.when(F.length(text) < 5, F.lpad(text, 5, "0")).otherwise(text) if pad else text
