"""Benchmark decontamination by winnowing.

Of the hashes of all ``K`` consecutive words, the smallest of every ``SPAN``
neighbours is a fingerprint. Two texts that share ``WINDOW = K + SPAN - 1``
words share all k-grams of that stretch and so its smallest: every shared
window yields a common fingerprint. Fingerprints of documents and benchmark
are joined; each hit is extended to the windows around it, and those are
compared word by word. An item shorter than a window is one window of its own
length, looked up at every position.

Before the join a bitmap of bounded size, made of the benchmark's
fingerprints, drops document fingerprints that cannot match. It only prunes.
The joins carry no hint: Spark broadcasts the benchmark's side if its stored
size allows, and shuffles otherwise.

Defined cases: NULL or empty text has no words and is clean; rows that repeat
a document are judged alike; an item without words is ignored; a NULL item id
counts as the empty text among the ids; other columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.llm import filters
from txnflow.llm import words as W
from txnflow.llm.common import LETTER_WORD, ascii_lower, row_struct, store, whole_text

K, SPAN = 8, 6
WINDOW = K + SPAN - 1
#: A document is contaminated when 1 of this many words is hit.
ONE_IN = 20

_HIT = "struct<fp: bigint, first: int, len: int, words: string>"
_HIT_TYPE = pa.struct([("fp", pa.int64()), ("first", pa.int32()), ("len", pa.int32()), ("words", pa.string())])


def fingerprints(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, k-gram hashes) chosen from one text's word hashes: the minimum of each span."""
    g = W.grams(h, K)
    n = len(g) - SPAN + 1
    if n <= 0:
        return np.zeros(0, np.int64), g[:0]
    best = np.zeros(n, np.int64)
    least = g[:n].copy()
    for j in range(1, SPAN):
        other = g[j : n + j]
        less = other < least
        best[less] = j
        least[less] = other[less]
    at = np.unique(best + np.arange(n))
    return at, g[at]


def _whole(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of a short item's length, apart from those of other lengths."""
    return W.mix(W.grams(h, length) ^ np.uint64(length * 0x9E3779B9))


def benchmark_prints(items: DataFrame) -> DataFrame:
    """(fp, len) of the benchmark: winnowed, or the whole of a short item."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, w in W.chunks(batch.column(0), W.LETTERS):
                h = w.hashes()
                prints, lens = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
                for a, b in zip(w.first[:-1], w.first[1:]):
                    if a < b:
                        short = b - a < WINDOW
                        got = _whole(h[a:b], int(b - a)) if short else fingerprints(h[a:b])[1]
                        prints.append(got)
                        lens.append(np.full(len(got), b - a if short else WINDOW, np.int32))
                columns = [np.concatenate(prints).view(np.int64), np.concatenate(lens)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "len"])

    return items.select(whole_text(items).alias("text")).mapInArrow(task, "fp long, len int").distinct()


def document_prints(docs: DataFrame, bitmap: np.ndarray, short: list[int]) -> DataFrame:
    """``docs`` (id columns, then ``text``) as id columns, n_words and the fingerprints the bitmap lets pass.

    Each comes with the words around it: all windows that could hold it.
    """
    ids = [c for c in docs.columns if c != "text"]

    def of_text(w: W.Words, h: np.ndarray, a: int, b: int, out: list) -> int:
        had = len(out)
        at, prints = fingerprints(h[a:b])
        passed = filters.has(bitmap, prints)
        for p, fp in zip(at[passed], prints[passed].view(np.int64)):
            lo, hi = max(a, a + p - (SPAN - 1)), min(b, a + p + WINDOW)
            out.append((int(fp), int(lo - a), WINDOW, w.text(lo, hi)))
        for n in short:
            g = _whole(h[a:b], n)
            for p in np.flatnonzero(filters.has(bitmap, g)) if len(g) else ():
                out.append((int(g[p : p + 1].view(np.int64)[0]), int(p), n, w.text(a + p, a + p + n)))
        return len(out) - had

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c) for c in ids]
            for lo, hi, w in W.chunks(batch.column("text"), W.LETTERS):
                h, hits = w.hashes(), []
                counts = np.array([of_text(w, h, a, b, hits) for a, b in zip(w.first[:-1], w.first[1:])])
                fields = list(zip(*hits)) or [()] * 4
                values = pa.StructArray.from_arrays(
                    [pa.array(f, t.type) for f, t in zip(fields, _HIT_TYPE)], fields=list(_HIT_TYPE)
                )
                yield pa.RecordBatch.from_arrays(
                    [*(k.slice(lo, hi - lo) for k in keys), pa.array(np.diff(w.first)), W.list_array(values, counts)],
                    [*ids, "n_words", "hits"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(task, f"{fields}, n_words long, hits array<{_HIT}>")


def _windows(words: Column, length: Column) -> Column:
    """(offset, text) of every window of ``length`` words."""
    return F.transform(
        F.sequence(F.lit(0), F.size(words) - length),
        lambda i: F.struct(i.alias("offset"), F.array_join(F.slice(words, i + 1, length), " ").alias("window")),
    )


def benchmark_windows(items: DataFrame) -> DataFrame:
    """(window, item) for all windows of all items."""
    words = F.regexp_extract_all(ascii_lower(whole_text(items)), F.lit(LETTER_WORD), F.lit(0))
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("w"))
    rows = rows.where(F.size("w") > 0)
    return rows.select(
        "item", F.explode(_windows(F.col("w"), F.least(F.size("w"), F.lit(WINDOW)))).alias("x")
    ).select(F.col("x.window").alias("window"), "item").distinct()


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, th (hash of its text), n_words, n_hit, n_items, items, contaminated."""
    prints = store(benchmark_prints(items), "benchmark-prints")
    short = sorted(r["len"] for r in prints.where(F.col("len") < WINDOW).select("len").distinct().collect())
    bitmap = filters.build(prints, F.col("fp"), filters.bits_for(prints.count(), 256))
    windows = store(benchmark_windows(items), "benchmark-windows")

    text = whole_text(docs)
    source = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    base = store(document_prints(source, bitmap, short), "document-prints")
    keys = ["doc_id", "th"]
    near = base.where(F.size("hits") > 0).select(*keys, F.explode("hits").alias("h")).select(*keys, "h.*")
    near = near.join(prints.select("fp").distinct(), "fp", "left_semi")
    around = near.select(*keys, "first", "len", F.split("words", " ").alias("w")).where(F.size("w") >= F.col("len"))
    spots = around.select(*keys, "first", "len", F.explode(_windows(F.col("w"), F.col("len"))).alias("x"))
    spots = spots.select(*keys, (F.col("first") + F.col("x.offset")).alias("start"), "len", F.col("x.window").alias("window"))
    hits = store(
        spots.distinct().join(windows.select("window").distinct(), "window", "left_semi"), "window-hits"
    )
    # words under at least one window: what each adds beyond the furthest end before it
    ends = F.max(F.col("start") + F.col("len")).over(
        _by_start(keys).rowsBetween(-(2**31), -1)
    )
    added = F.col("start") + F.col("len") - F.greatest(F.col("start"), F.coalesce(ends, F.lit(0)))
    covered = hits.select(*keys, F.greatest(added, F.lit(0)).alias("added")).groupBy(*keys).agg(F.sum("added").alias("n_hit"))
    found = (
        hits.select(*keys, "window").distinct().join(windows, "window").groupBy(*keys)
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    per_text = covered.alias("c").join(found.alias("f"), _same("c", "f")).select("c.*", "f.items")
    out = base.drop("hits").alias("b").join(per_text.alias("p"), _same("b", "p"), "left")
    n_hit = F.coalesce(F.col("p.n_hit"), F.lit(0)).cast("long")
    return out.select(
        *(f"b.{k}" for k in keys),
        "b.n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("p.items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("p.items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("b.n_words"))).alias("contaminated"),
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def _by_start(keys: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy("start", "len")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    bad = contamination(docs, items).where("contaminated").select("doc_id", F.col("th").alias("_th")).distinct()
    text_hash = F.xxhash64(whole_text(docs)).alias("_hash")
    keyed = docs.select(row_struct(docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), text_hash)
    clean = keyed.join(bad, keyed["_doc"].eqNullSafe(bad["doc_id"]) & (keyed["_hash"] == bad["_th"]), "left_anti")
    return clean.select("_row.*")
