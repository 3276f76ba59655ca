"""Phrase collocations from a weighted de Bruijn graph.

Nodes are word trigrams, edges the four-grams that overlap in them, weighted by
their occurrences. Every word position gives exactly one edge: the longest
gram of up to ``LONGEST`` words from it on that stays in its piece. A shorter
gram is such an edge only where a piece ends. So counts of shorter grams need
no pass of their own: the occurrences of a node are what flows out of it, the
weights of its edges plus the positions that end there, and from trigrams to
pairs and words the same again.

Edges are pruned first. A pair of words rarer than ``min_count`` is in no
candidate, so a position's gram also ends before such a pair. Pairs are counted
by hash into at most ``BUCKETS`` counters; a bitmap of the counters that reach
``min_count`` can only let more pairs pass than needed, never fewer, so all
counts of frequent grams stay exact whatever the size of the corpus.

The edges that are candidates are compacted: where a node has one edge in and
one out and all its occurrences run through both, the edges are one path.
Paths are found by pointer doubling over stored tables, in rounds that grow
with the logarithm of the longest path, and are cut into rows of ``SEGMENT``
edges. They state which shorter phrases lie inside four-grams, each once.

Defined cases: NULL text is empty, a NULL lang is ``und``; an empty table gives
no rows; rows that repeat count each time; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm import filters
from txnflow.llm import words as W
from txnflow.llm.common import store

LONGEST = 4
MIN_COUNT, TOP = 30, 2000
#: A phrase is dropped when a longer candidate around it has at least this share of its occurrences.
COVER_PERCENT = 80
SCALE = 2_000_000
#: Counters of word pairs; one bit of the pruning bitmap each (8 MiB).
BUCKETS = 1 << 26
#: Edges in one row of a compacted path.
SEGMENT = 64
#: Phrases of one language are ranked in so many parts first.
RANK_PARTS = 64
#: Bytes of text that are cut into words at once; its arrays take about 40 times as much.
CHUNK = 2 << 20
NO_LANG = "und"

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


@dataclass
class _Chunk:
    """Word positions of some texts, as codes of their distinct (word, lang)."""

    lang: np.ndarray  # of each word
    words: np.ndarray  # code of each word
    data: np.ndarray  # bytes of all words, without gaps
    offsets: np.ndarray
    joined: np.ndarray  # the next word is in the same piece
    pairs: np.ndarray  # hash of the word and the next one

    def grams(self, at: np.ndarray, size: int) -> pa.Array:
        """The texts of ``size`` words from each position on, joined by one space."""
        starts = self.offsets[at] + at
        lens = self.offsets[at + size] + at + size - 1 - starts
        ends = np.cumsum(lens)
        pick = np.arange(int(lens.sum())) + np.repeat(starts - (ends - lens), lens)
        offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
        text = pa.LargeStringArray.from_buffers(len(at), offsets, pa.py_buffer(self._spaced()[pick]))
        return text.cast(pa.string())

    def _spaced(self) -> np.ndarray:
        if not hasattr(self, "_buffer"):
            lens = np.diff(self.offsets)
            self._buffer = np.full(len(self.data) + len(lens), 32, dtype=np.uint8)
            self._buffer[np.arange(len(self.data)) + np.repeat(np.arange(len(lens)), lens)] = self.data
        return self._buffer


def _chunks(batch: pa.RecordBatch, langs: dict[str, int]) -> Iterator[_Chunk]:
    """Chunks of a batch with columns lang and text; ``langs`` numbers the languages met so far."""
    if not len(batch):
        return
    of_row = np.fromiter((langs.setdefault(x, len(langs)) for x in batch.column("lang").to_pylist()), np.int64, len(batch))
    # the hash of a language's name is the same in every task
    seed = _hashes(pa.array([name + " " for name in langs], pa.large_string()))
    for a, b, found in W.chunks(batch.column("text"), _WORD, CHUNK):
        n = len(found.start)
        if not n:
            continue
        text = np.repeat(np.arange(b - a), np.diff(found.first))
        piece = np.searchsorted(np.flatnonzero(_BREAK[found.low]), found.start)
        joined = np.zeros(n, dtype=bool)
        joined[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        data = found.low[_WORD[found.low]]
        offsets = np.concatenate([[0], np.cumsum(found.end - found.start)])
        array = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
        coded = array.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        h = _hashes(coded.dictionary)[code]
        lang = of_row[a:b][text]
        pairs = np.zeros(n, dtype=np.uint64)
        pairs[:-1] = W.mix(W.mix(h[:-1] + seed[lang[:-1]]) + h[1:])
        yield _Chunk(lang, code * len(langs) + lang, data, offsets, joined, pairs)


def _hashes(words: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    return W.Words(np.frombuffer(words.buffers()[2], dtype=np.uint8), offsets[:-1], offsets[1:], offsets[:1]).hashes()


def _rows(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))


def frequent_pairs(docs: DataFrame, min_count: int = MIN_COUNT) -> np.ndarray:
    """Bitmap of the counters that ``min_count`` or more word pairs fall into."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        for batch in batches:
            for c in _chunks(batch, langs):
                bucket, n = np.unique(c.pairs[c.joined] & np.uint64(BUCKETS - 1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(n)], ["bucket", "n"])

    counters = _rows(docs).mapInArrow(task, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return filters.build(counters.where(F.col("n") >= min_count), F.col("bucket").cast("long"), BUCKETS)


def edges(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, gram, k, n): the longest gram from every word position on, of k words, and its positions."""
    bitmap = docs.sparkSession.sparkContext.broadcast(frequent_pairs(docs, min_count))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        for batch in batches:
            for c in _chunks(batch, langs):
                yield from _longest_grams(c, bitmap.value, list(langs))

    found = _rows(docs).mapInArrow(task, "lang string, gram string, k int, n long")
    return store(found.groupBy("lang", "gram", "k").agg(F.sum("n").alias("n")), "gram-edges")


def _longest_grams(c: _Chunk, bitmap: np.ndarray, langs: list[str]) -> Iterator[pa.RecordBatch]:
    """The edges of a chunk, each distinct one once.

    Grams are compared by codes that are unique in the chunk: of words, of
    pairs, of a pair with a word, of two pairs. No hash decides.
    """
    on = c.joined.copy()
    on[on] = filters.has(bitmap, c.pairs[on] & np.uint64(BUCKETS - 1))
    size = np.ones(len(on), dtype=np.int8)
    run = on.copy()
    for j in range(1, LONGEST):
        size += run
        run[:-j] &= on[j:]
        run[-j:] = False
    at = np.flatnonzero(on)
    pair = np.zeros(len(on), dtype=np.int64)
    pair[at] = np.unique(c.words[at] * (c.words.max() + 1) + c.words[at + 1], return_inverse=True)[1]
    most = int(max(pair.max(), c.words.max())) + 1
    for k in range(1, LONGEST + 1):
        at = np.flatnonzero(size == k)
        if not len(at):
            continue
        key = c.words[at] if k == 1 else pair[at]
        if k > 2:
            key = key * most + (c.words if k == 3 else pair)[at + 2]
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        lang = pa.array(langs, pa.string()).take(pa.array(c.lang[at]))
        columns = [lang, c.grams(at, k), pa.array(np.full(len(at), k, np.int32)), pa.array(n)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "k", "n"])


def _total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def node_flows(edge_rows: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, gram, k, n) of all grams of 1 to ``LONGEST`` words with at least ``min_count`` occurrences.

    What flows out of a gram: the longer grams that begin with it, plus the
    positions where it is itself the longest.
    """
    of = lambda k: edge_rows.where(F.col("k") == k).select("lang", "gram", "n")
    level = of(LONGEST)
    out = level.where(F.col("n") >= min_count).withColumn("k", F.lit(LONGEST))
    for k in range(LONGEST - 1, 0, -1):
        begin = level.select("lang", F.substring_index("gram", " ", k).alias("gram"), "n")
        level = store(_total(begin.unionByName(of(k))), "gram-flows")
        out = out.unionByName(level.where(F.col("n") >= min_count).withColumn("k", F.lit(k)))
    return store(out.select("lang", "gram", "k", "n"), "gram-counts")


def _first(gram: str, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def _last(gram: str, k: int) -> Column:
    return F.substring_index(gram, " ", -k)


def compact_paths(counts: DataFrame) -> DataFrame:
    """(lang, words, n): the frequent longest grams as paths, each row up to ``SEGMENT`` edges of one path."""
    k = LONGEST - 1
    edge = counts.where(F.col("k") == LONGEST).select("lang", "gram", "n")
    node = counts.where(F.col("k") == k).select("lang", F.col("gram").alias("node"), F.col("n").alias("flow"))
    ends = edge.select("lang", _last("gram", k).alias("node"), F.col("gram").alias("before"), F.col("n").alias("into"))
    begins = edge.select("lang", _first("gram", k).alias("node"), F.col("gram").alias("after"), F.col("n").alias("out"))
    # all occurrences of the node come by one edge and go by one edge: no other edge can have any
    unary = ends.join(node, ["lang", "node"]).where("into = flow").join(begins.where("out is not null"), ["lang", "node"])
    unary = unary.where("out = flow").select("lang", F.col("after").alias("gram"), "before")
    step = edge.join(unary, ["lang", "gram"], "left")
    here = F.coalesce("before", "gram").alias("head")
    step = store(step.select("lang", "gram", "n", here, F.col("before").isNotNull().cast("int").alias("at")), "paths")
    while True:
        ahead = step.where("at > 0").select("lang", F.col("gram").alias("head"), F.col("head").alias("far"), F.col("at").alias("more"))
        jumped = step.join(ahead, ["lang", "head"], "left").select(
            "lang", "gram", "n", F.coalesce("far", "head").alias("head"),
            (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"), F.col("far").isNotNull().alias("moved"),
        )
        step = store(jumped, "paths")
        if step.where("moved").isEmpty():
            break
    part = F.floor(F.col("at") / SEGMENT).cast("int")
    rows = step.groupBy("lang", "head", part.alias("part")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "gram"))).alias("edges")
    )
    start = F.split(F.col("edges")[0]["gram"], " ")
    more = F.transform(F.slice("edges", 2, SEGMENT), lambda e: F.substring_index(e["gram"], " ", -1))
    return rows.select("lang", F.concat(start, more).alias("words"), "n")


def _inside(words: str, size: int) -> Column:
    """All grams of ``size`` words inside an array of words."""
    starts = F.sequence(F.lit(1), F.size(words) - (size - 1))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def covered(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """(lang, gram, longer): the most occurrences of a longer candidate around each phrase."""
    around = []
    for size in range(2, LONGEST):
        around.append(paths.select("lang", F.explode(_inside("words", size)).alias("gram"), "n"))
        for k in range(size + 1, LONGEST):
            longer = counts.where(F.col("k") == k).select("lang", F.split("gram", " ").alias("words"), "n")
            around.append(longer.select("lang", F.explode(_inside("words", size)).alias("gram"), "n"))
    rows = around[0]
    for more in around[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("lang", "gram").agg(F.max("n").alias("longer"))


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of every candidate by its lowest-scoring cut."""
    size = F.size(F.split("gram", " "))
    cuts = counts.where("k > 1").select(
        "lang", F.col("gram").alias("phrase"), F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"), "k"
    )
    cuts = cuts.withColumns({
        "left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)"),
    })
    part = lambda side, name: counts.select("lang", F.col("gram").alias(side), F.col("n").alias(name))
    both = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    # the product may pass 64 bits
    score = F.expr(f"(cast(a as decimal(28, 0)) * {SCALE}) div (cast(l as decimal(28, 0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r"))
    best = both.groupBy("lang", "phrase", "a").agg(lowest.alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", "x.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``LONGEST`` words."""
    found = edges(docs, min_count)
    # every position is in exactly one edge
    total = found.groupBy("lang").agg(F.sum("n").alias("n"))
    counts = node_flows(found, min_count)
    longer = covered(counts, compact_paths(counts)).withColumnRenamed("gram", "phrase")
    rows = scored(counts).join(longer, ["lang", "phrase"], "left")
    rows = rows.where(f"longer is null or 100 * longer < {COVER_PERCENT} * a").drop("longer")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    near = rows.withColumn("_part", part)
    near = near.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = near.where(F.col("_at") <= top).drop("_part", "_at")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
