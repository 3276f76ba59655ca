"""Tables whose other columns are named like an operator's inner ones, or as no plain name is."""

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import prose
from tests.llm.test_decontaminate import ITEMS
from txnflow.llm import (
    collocations, decontaminate, html_text, jaccard_join, license_scan, line_dedup, quality_rules, secrets_scan,
    sentencepiece_bpe, sharding, url_filter, whitening,
)
from txnflow.llm.queries import piece_model

NAMES = """_text _w _l _h _g _s _row _doc _id _th _hash _lost _lines _none _stratum _own _limits _page _url _low _rule row at
    cls n low col who th h h1 h2 owner first last window item hits fp live comp root label weight bucket total y id rank phrase
    my-col a.b x`y""".split()


def odd(spark, rows, fields):
    """Rows with a text or nested column of every inner name."""
    df = spark.createDataFrame(rows, fields)
    quoted = lambda n: "`" + n.replace("`", "``") + "`"
    extra = [n for n in NAMES if n not in df.columns]
    return df.select("*", *(F.expr(f"'mine' as {quoted(n)}") for n in extra), F.struct(F.lit(1).alias("p-q")).alias("nested.one"))


def docs(spark):
    rows = [(1, prose(40, 1), "en"), (2, None, None), (None, "a line of some length\n" + prose(30, 3), "en"), (3, prose(40, 1), "en")]
    return odd(spark, rows, "doc_id long, text string, lang string")


def labels(spark):
    return spark.createDataFrame([(1, 1)], "doc_id long, quality int")


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


RUNS = {
    "secrets": lambda s, d: secrets_scan.find_secrets(d),
    "decontamination": lambda s, d: decontaminate.drop_contaminated(d, items(s)),
    "jaccard": lambda s, d: jaccard_join.keep_one(d),
    "quality": lambda s, d: quality_rules.keep_good(d, labels(s)),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
    "pieces": lambda s, d: sentencepiece_bpe.encode(d, piece_model()),
}


@pytest.mark.parametrize("name", RUNS)
def test_columns_pass_unchanged(spark, name):
    given = docs(spark)
    got = RUNS[name](spark, given)
    kept = [c for c in given.columns if c in got.columns and c != "text"]
    assert set(given.columns) - set(got.columns) == set()
    rows = [r.asDict(recursive=True) for r in got.collect()]
    source = {r["doc_id"]: r.asDict(recursive=True) for r in given.collect()}
    assert rows and all(r[c] == source[r["doc_id"]][c] for r in rows for c in kept)


def test_other_tables(spark):
    given = docs(spark)
    assert license_scan.scan_licenses(given).count() == 4
    assert sharding.assign_shards(given, 2).count() == 4
    assert collocations.collocations(given).count() == 0
    pages = odd(spark, [(1, "http://a.net/x", "<p>Some text of a page</p>"), (None, None, None)], "page_id long, url string, html string")
    out = html_text.extract_text(pages)
    assert out.count() == 2 and set(pages.columns) - {"html"} <= set(out.columns)
    out = url_filter.judge_urls(pages)
    assert [r["rule"] for r in out.orderBy(F.desc("page_id")).collect()] == ["net/", None]
    vectors = odd(spark, [(1, [1.0, 2.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(vectors).count() == 2


def test_words_of_a_simple_build_have_their_own_hashes(spark):
    """Thue-Morse words and their complements met in one hash when it was a polynomial."""
    rows = []
    for k in (10, 11, 12):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(2**k))
        rows += [(2 * k, word), (2 * k + 1, word.translate(str.maketrans("ab", "ba")))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    parts = {r["doc_id"]: r["component_id"] for r in jaccard_join.similarity_components(df).collect()}
    assert parts == {i: i for i, _ in rows}
    bench = spark.createDataFrame([(i, t) for i, t in rows if i % 2], "item_id long, text string")
    hit = {r["doc_id"] for r in decontaminate.contamination(df, bench).where("contaminated").collect()}
    assert hit == {i for i, _ in rows if i % 2}
