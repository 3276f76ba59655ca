"""Counts against plain loops, paths against the repeated passages they come from, rows against SQL."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.llm.brute import EDGE, docs_of, low
from txnflow.llm import collocations as C
from txnflow.llm.queries import QUERIES
from txnflow.llm.sql import SQL


def corpus():
    rng = random.Random(3)
    words = "the of and cat dog sat on a mat".split() + ["été", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60))) + rng.choice([".", "!\n", "\t", ""])) for i in range(400)]
    hot = "no man is an island entire of itself, every man is a piece; " + " ".join(f"w{i}" for i in range(150))
    rows += [(1000 + i, hot.upper() if i % 2 else hot) for i in range(40)]
    rows += [(2000 + i, "again " * 50) for i in range(5)] + [(3000 + i, "x y\x0bz\x0cx y\x1fz") for i in range(31)]
    return rows + EDGE


def brute(rows, min_count):
    """(candidates' rows in order, counts) of one language."""
    f, n = Counter(), 0
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n += len(w)
            f.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
    out = []
    for g, a in cand.items():
        longer = [b for h, b in cand.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
        out.append((" ".join(g), a, f[g[:k]], f[g[k:]], n, score))
    return sorted(out, key=lambda r: (-r[5], -r[1], r[0].encode())), f


def test_rows_equal_plain_loops(spark):
    rows = corpus()
    got = C.collocations(docs_of(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want, _ = brute(rows, 30)
    assert sorted(tuple(r)[1:] for r in got.collect()) == [(i, *r) for i, r in enumerate(want[:2000], 1)]
    few = C.collocations(docs_of(spark, rows), min_count=5, top=7).collect()
    assert sorted(tuple(r)[1:] for r in few) == [(i, *r) for i, r in enumerate(brute(rows, 5)[0][:7], 1)]


def test_counts_come_from_flows(spark):
    """Every frequent gram has its exact count, though only longest grams were counted."""
    rows = corpus()
    counts = C.node_flows(C.edges(docs_of(spark, rows), 10), 10)
    _, f = brute(rows, 10)
    singles = {" ".join(g): n for g, n in f.items() if n >= 10}
    got = {r["gram"]: r["n"] for r in counts.collect()}
    # a word of no frequent pair is still counted: it is an edge of its own
    assert got == singles


def test_unary_paths_are_compacted(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(150))) for i in range(30)]
    counts = C.node_flows(C.edges(docs_of(spark, rows)))
    paths = C.compact_paths(counts).collect()
    assert sorted(len(r["words"]) for r in paths) == sorted([67, 67, 150 - 128])  # 147 edges in rows of 64
    assert {r["n"] for r in paths} == {30}
    branching = rows + [(100 + i, "w10 w11 w12 other") for i in range(3)]
    paths = C.compact_paths(C.node_flows(C.edges(docs_of(spark, branching)))).collect()
    assert any(r["words"][-1] == "w12" for r in paths) and any(r["words"][0] == "w10" for r in paths)


def test_languages_apart_and_empty_tables(spark):
    rows = [(i, "ab cd ab cd") for i in range(20)]
    docs = docs_of(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 10, F.lit(None)).otherwise("fr"))
    assert C.collocations(docs).count() == 0  # 20 and 10 of each pair
    got = {(r["lang"], r["phrase"]): (r["a"], r["n"]) for r in C.collocations(docs, min_count=15).collect()}
    assert got == {("und", "ab cd"): (20, 40), ("fr", "ab cd"): (20, 40)}
    assert C.collocations(docs_of(spark, [])).count() == 0


def test_a_long_text(spark):
    text = " ".join(random.Random(1).choices("a b c d e f g h".split(), k=300_000))
    rows = [(1, text), (2, None)]
    got = C.collocations(docs_of(spark, rows), min_count=4000)
    assert sorted(tuple(r)[1:] for r in got.collect()) == [(i, *r) for i, r in enumerate(brute(rows, 4000)[0], 1)] != []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES["op13_collocations"](spark, sf), connect(sf), SQL["op13_collocations"]) == []
