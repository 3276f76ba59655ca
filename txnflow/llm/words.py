"""Words and word k-grams of whole Arrow batches as flat numpy arrays.

The classes of the contracts are defined on ASCII only, every byte of a
multi-byte character counts as a word byte, so texts are cut on their UTF-8
bytes without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
LETTERS = np.zeros(256, dtype=bool)
LETTERS[48:58] = True
LETTERS[97:123] = True
LETTERS[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
#: Bytes of a word that have a table of their own.
_PLACES = 64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


#: A number for each byte at each place. A sum of powers would give some words of a simple build one hash.
_TABLE = mix(np.arange(_PLACES * 256, dtype=np.uint64) * _BASE + _MIX)


@dataclass
class Words:
    """Words of consecutive texts; text ``t`` has words ``first[t]`` to ``first[t + 1]``."""

    low: np.ndarray  # lower-cased bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        lens = self.end - self.start
        if not len(lens):
            return np.zeros(0, dtype=np.uint64)
        off = np.cumsum(lens) - lens
        within = np.arange(int(lens.sum())) - np.repeat(off, lens)
        byte = self.low[np.repeat(self.start, lens) + within]
        value = _TABLE[(within & (_PLACES - 1)) << 8 | byte]
        far = np.flatnonzero(within >= _PLACES)
        if len(far):
            value[far] = mix(value[far] + (within[far] // _PLACES).astype(np.uint64) * _BASE)
        return mix(np.add.reduceat(value, off) + lens.astype(np.uint64))

    def text(self, a: int, b: int) -> str:
        """Words ``a`` to ``b`` (end exclusive), joined by one space."""
        raw = self.low
        return b" ".join(raw[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b])).decode("utf-8", "replace")


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on; the last k - 1 positions are absent."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    g = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        g = g * _BASE + h[j : n + j]
    return mix(g + np.uint64(k))


def chunks(column: pa.Array, word: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over pieces of about ``size`` bytes; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end, _cut(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], word)
        row = end


def _cut(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> Words:
    low = _LOWER[data]
    inside = word[low]
    edge = np.zeros(len(low) + 1, dtype=bool)  # a text begins or ends here
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(low, start, end, np.searchsorted(start, offsets))


def text_of(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each word position belongs to."""
    return np.searchsorted(first, at, "right") - 1


def list_array(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Lists of ``counts`` values each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
