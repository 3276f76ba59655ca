"""Counts against plain loops, thresholds against the binomial tail, and the rows of the query against SQL."""

import math
import random
import time

from pyspark.sql import functions as F

from tests.compare import connect, differences
from tests.llm.brute import EDGE, SPACED, docs_of, prose
from txnflow.llm import quality_rules as Q
from txnflow.llm.queries import QUERIES
from txnflow.llm.sql import SQL

TEXTS = EDGE + [
    (30, "a b c d e a b c d e"),
    (31, "a a a a a a a a a a a a a a"),
    (32, prose(40, 3) + " " + prose(9, 4) + " x " + prose(9, 4) + " y " + prose(9, 4)),
    (33, "# $ line\n# $ line\n \n \nend | <b>&%*</b>"),
    (34, "ÉCLAIR Ab"),
]


def one_label(spark):
    return spark.createDataFrame([(1, 1)], "doc_id long, quality int")


def brute(text):
    t = text or ""
    w = SPACED.findall(t)
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
        sum("A" <= c <= "Z" for c in t), len(lines),
    )


def test_counts(spark):
    got = Q.features(docs_of(spark, TEXTS))
    rows = sorted(((r["doc_id"], *(r[c] for c in Q.FEATURES)) for r in got.collect()), key=repr)
    assert rows == sorted(((i, *brute(t)) for i, t in TEXTS), key=repr)


def labelled(spark, n, noise=0, seed=5):
    """Good prose, and bad documents full of symbols; ``noise`` good ones look bad."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2 or i < noise
        text = " ".join(w + "###" * bad for w in prose(30, i).split())
        rows.append((i, text))
        labels.append((i, 0 if bad and i >= noise else 1))
    return docs_of(spark, rows), spark.createDataFrame([*labels, (None, 1), (n + 5, None)], "doc_id long, quality int")


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_thresholds_keep_their_guarantee(spark):
    docs, labels = labelled(spark, 2500, noise=3)
    measured = Q.features(docs)
    chosen = Q.thresholds(Q.holdout(measured, labels)).collect()
    assert [r["rule"] for r in chosen] == ["symbols"]
    r = chosen[0]
    assert math.isclose(r["tail"], tail(r["rejected_good"], r["good"], Q.RISK / len(Q.RULES)), rel_tol=1e-9)
    assert r["tail"] <= Q.ERROR / len(Q.RULES) and r["rejected_bad"] > 400
    assert r["risk"] == Q.RISK / len(Q.RULES)
    kept = Q.judge(measured, Q.thresholds(Q.holdout(measured, labels))).where("kept").count()
    assert kept == 2500 - r["rejected_good"] - r["rejected_bad"]


def histogram(spark, rows):
    """Measured labelled documents of one score each: (stratum, quality, symbols, capitals, how many)."""
    out = [(lang, q, sym, cap) for lang, q, sym, cap, n in rows for _ in range(n)]
    made = spark.createDataFrame(out, "lang string, quality int, n_symbols long, n_capitals long")
    fixed = {"n_words": 100, "word_chars": 1000, "n_dup_lines": 0, "n_repeat_words": 0, "n_lines": 10}
    return made.withColumns({c: F.lit(n).cast("long") for c, n in fixed.items()})


def test_few_labels_give_one_rule_the_whole_risk(spark):
    rows = [("a", 1, 1, 1, 400), ("a", 0, 300, 1, 20), ("a", 0, 1, 300, 15), ("b", 1, 1, 1, 1500), ("b", 0, 300, 1, 20), ("b", 0, 1, 300, 15)]
    got = Q.thresholds(histogram(spark, rows)).collect()
    assert sorted((r["stratum"], r["rule"], r["threshold"], r["risk"]) for r in got) == [
        ("a", "symbols", 300, Q.RISK), ("b", "capitals", 300, Q.RISK / 4), ("b", "symbols", 300, Q.RISK / 4),
    ]
    for r in got:
        assert math.isclose(r["tail"], tail(0, r["good"], r["risk"]), rel_tol=1e-9)
        assert r["tail"] <= Q.ERROR / (len(Q.RULES) * 2)


def test_thin_strata_are_judged_together(spark):
    """Three of 100 good labels each and a NULL one of 10 reach what one needs; the large one stays its own."""
    rows = [(x, 1, 1, 1, 100) for x in "abc"] + [(None, 1, 1, 1, 10), ("a", 0, 300, 1, 9), ("a", 1, 200, 1, 1)]
    got = Q.thresholds(histogram(spark, rows)).collect()
    assert sorted(r["stratum"] for r in got) == ["", "a", "b", "c"]
    assert {(r["rule"], r["threshold"], r["good"], r["rejected_bad"]) for r in got} == {("symbols", 300, 311, 9)}
    large = Q.thresholds(histogram(spark, [*rows, ("d", 1, 1, 1, 900), ("d", 0, 1, 500, 30)])).collect()
    assert {(r["rule"], r["good"]) for r in large if r["stratum"] == "d"} == {("capitals", 900)}
    assert {r["good"] for r in large if r["stratum"] != "d"} == {311}


def test_rules_reject_few_good_documents_of_a_stratum(spark):
    """Many draws at the edge: the share of labelled sets whose true loss passes the risk stays below the error."""
    n, loss = 320, 0.021  # one good document in 48 looks bad, a little more than the risk
    rng = random.Random(11)
    draws = [sum(rng.random() < loss for _ in range(n)) for _ in range(4000)]
    wrong = sum(tail(k, n, Q.RISK) <= Q.ERROR / len(Q.RULES) for k in set(draws) for _ in range(draws.count(k)))
    assert wrong <= Q.ERROR * len(draws)
    k = max(i for i in range(20) if tail(i, n, Q.RISK) <= Q.ERROR / len(Q.RULES))
    for hit, allowed in ((k, True), (k + 1, False)):
        rows = [("a", 1, 1, 1, n - hit), ("a", 1, 300, 1, hit), ("a", 0, 300, 1, 400)]
        assert bool(Q.thresholds(histogram(spark, rows)).count()) == allowed


def test_too_few_labels_give_no_threshold(spark):
    docs, labels = labelled(spark, 100)
    assert Q.thresholds(Q.holdout(Q.features(docs), labels)).count() == 0
    assert Q.keep_good(docs, labels).count() == 100


def test_good_documents_that_look_bad_push_the_threshold_away(spark):
    docs, labels = labelled(spark, 1500, noise=60)
    for r in Q.thresholds(Q.holdout(Q.features(docs), labels)).collect():
        assert Q.COST * r["rejected_good"] < r["rejected_bad"] and r["rejected_good"] <= 3


def test_long_texts_are_filtered_in_linear_time(spark):
    """The filter on the verdict must not reach the text: it would cut it once for each word."""
    rows = [(i, prose(20000, i)) for i in range(4)] + [(9, "again and again " * 7000)]
    start = time.time()
    assert sorted(r[0] for r in Q.keep_good(docs_of(spark, rows), one_label(spark)).select("doc_id").collect()) == [0, 1, 2, 3]
    assert time.time() - start < 60


def test_columns_named_like_inner_ones_pass(spark):
    names = ["_text", "_w", "_row", "_doc", "_stratum", "_own", "_limits", "base_failed", "kept", "n_words", "my-col", "a.b"]
    docs = docs_of(spark, [(1, prose(30, 1)), (2, "short")]).withColumns({n: F.lit("mine") for n in names if n != "a.b"})
    docs = docs.select("*", F.struct(F.lit(1).alias("x-y")).alias("a.b"))
    got = Q.keep_good(docs, one_label(spark))
    assert got.dtypes == docs.dtypes
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in docs.where("doc_id = 1").collect()]


def test_edge_rows_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = docs_of(spark, TEXTS).withColumn("lang", F.lit(None).cast("string"))
    got = Q.judged(docs, none)
    assert got.count() == len(TEXTS)
    assert got.where("kept = base_failed").count() == 0
    assert Q.keep_good(docs, none).schema == docs.schema  # its own n_lines column stays
    assert Q.judged(docs_of(spark, []), none).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES["op5_quality_rules"](spark, sf), connect(sf), SQL["op5_quality_rules"]) == []


def test_query_equals_sql_where_strata_are_pooled(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_rules"](spark, sf)
    assert got.where("not kept and not base_failed").count() > 0
    assert differences(got, connect(sf), SQL["op5_quality_rules"]) == []


def test_query_equals_sql_where_thresholds_exist(spark, tmp_path):
    docs, labels = labelled(spark, 1500)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op5_quality_rules"](spark, str(tmp_path))
    assert got.where("not kept and not base_failed").count() > 0
    assert differences(got, connect(str(tmp_path)), SQL["op5_quality_rules"]) == []
