"""Bitmaps of bounded size that let tasks skip rows no join could match.

A bitmap may only prune: a set bit proves nothing, so the exact join follows.
Its size is bounded by ``MAX_BITS`` whatever the corpus; when a set outgrows
it, more rows pass and the join does more work, with the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MiB
MAX_BITS = 1 << 26
_BLOCK = 32768  # bits in one value of bitmap_construct_agg


def bits_for(n: int, per_value: int = 16, most: int = MAX_BITS) -> int:
    """A power of two of about ``per_value`` bits for each of ``n`` values, at most ``most``."""
    return min(most, max(1 << 17, 1 << max(0, int(n * per_value - 1)).bit_length()))


def build(df: DataFrame, value: Column, bits: int) -> np.ndarray:
    """The bitmap of ``value`` (a long) over all rows; blocks are merged on the executors."""
    at = F.pmod(value, F.lit(bits))
    rows = (
        df.where(value.isNotNull())
        .groupBy(F.bitmap_bucket_number(at + 1).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits"))
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for block, part in rows.toLocalIterator():  # bits / 32768 rows of 4 KiB
        at0 = (block - 1) * _BLOCK // 8
        out[at0 : at0 + len(part)] = np.frombuffer(bytes(part), dtype=np.uint8)
    return out


def has(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit of each 64-bit value is set."""
    at = values.astype(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
