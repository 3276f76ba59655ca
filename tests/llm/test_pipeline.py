"""The stages in a row against the brute-force versions of all of them."""

import hashlib

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_decontaminate, test_jaccard_join, test_line_dedup, test_quality_rules
from tests.llm.brute import prose
from txnflow.llm.queries import piece_model


def corpus():
    shared = prose(12, 901)
    rows = [(i, prose(30 + i, 300 + i)) for i in range(12)]
    rows += [(20, prose(80, 7)), (21, prose(80, 7)), (22, prose(80, 7) + " tail"), (23, prose(80, 7).upper())]
    rows += [(30 + i, f"{shared}\n{prose(25, 600 + i)}") for i in range(4)]  # one line in several documents
    rows += [(40, prose(40, 5)), (41, prose(60, 71) + " " + prose(40, 5)), (42, prose(900, 72) + " " + prose(14, 6))]
    rows += [(50, None), (51, ""), (52, "too short"), (53, "again and again it goes " * 9), (54, shared)]
    return rows


def brute(rows, items, library):
    rows = [(i, t) for i, t in rows if (b := test_quality_rules.brute(t))[0] >= 10 and 100 * b[4] <= 20 * b[0]]
    texts = {i: t for i, t, *_ in test_line_dedup.brute(rows)}
    rows = [(i, texts[i]) for i, _ in rows]
    rows = [(i, texts[i]) for i, n, c in test_jaccard_join.brute(rows) if not n or c == i]
    bad = {r[0] for r in test_decontaminate.brute(rows, items) if r[5]}
    out = []
    for i, t in rows:
        if i not in bad:
            ids = library.encode(t, add_eos=True)
            joined = " ".join(map(str, ids))
            out.append((i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (joined, library.decode(ids)))))
    return sorted(out)


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars")
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = test_decontaminate.ITEMS
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    got = corpus_pipeline.run(spark, str(tmp_path))
    want = brute(rows, items, library)
    assert sorted(map(tuple, got.collect())) == want
    assert {i for i, *_ in want} >= set(range(12)) and not {22, 40, 41, 50, 52, 53} & {i for i, *_ in want}


def test_thresholds_and_long_texts_reach_every_stage(spark, tmp_path):
    """Enough labels for a threshold: junk goes by it, long and clean documents stay, a group of copies leaves one."""
    docs, labels = test_quality_rules.labelled(spark, 1500)
    long = [(10_000 + i, prose(20000, 5000 + i)) for i in range(2)]
    copies = [(20_000 + i, prose(60, 4242) + f" tail{i}") for i in range(300)]
    docs = docs.union(test_quality_rules.docs_of(spark, long + copies))
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame(test_decontaminate.ITEMS, "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r[0] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    bad = {r[0] for r in labels.where("quality = 0").collect()}
    assert len(bad) > 200 and not bad & got
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    leaked = {r[0] for r in test_decontaminate.brute(rows, test_decontaminate.ITEMS) if r[5]}
    assert got == {i for i, _ in rows} - bad - leaked - set(range(20_001, 20_300))


def test_stages_keep_the_columns_of_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).schema.names == docs.schema.names
