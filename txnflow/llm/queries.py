"""The numbered queries: each derives its digest columns from one operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm.chat_format import digests as chat_digests
from txnflow.llm.chat_format import format_conversations, read_back, text_parts
from txnflow.llm.collocations import collocations
from txnflow.llm.common import table
from txnflow.llm.decontaminate import contamination
from txnflow.llm.html_text import extract_text
from txnflow.llm.jaccard_join import similarity_components
from txnflow.llm.license_scan import scan_licenses
from txnflow.llm.line_dedup import dedup_lines
from txnflow.llm.quality_rules import judged
from txnflow.llm.secrets_scan import BASE_KINDS, find_secrets, span_list
from txnflow.llm.sentencepiece_bpe import digests, encode
from txnflow.llm.sharding import assign_shards
from txnflow.llm.url_filter import judge_urls
from txnflow.llm.whitening import whiten


def piece_model() -> str:
    """The given vocabulary file; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")



def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda kinds: F.filter("secrets", lambda s: s["kind"].isin(kinds))
    counts = [F.size(of([k])).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.sha2(span_list(of(BASE_KINDS)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, span_list(F.col("secrets")).alias("spans"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents")).drop("th")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    counts = [F.size(f"{k}_terms").cast("long").alias(f"n_{k}") for k in ("strict", "soft")]
    return out.select("page_id", "host", "path", "rule", "verdict", *counts)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    labels = lambda c: F.array_join(F.sort_array(F.array_distinct(c)), ",")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"),
        F.array_max("starts").cast("long").alias("last_word"),
        labels(F.col("base")).alias("base_labels"),
        labels(F.concat("base", "templates")).alias("labels"),
        "score",
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


#: A conversation that holds control strings, beside those of the table.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.union(spark.createDataFrame(CONTROL_TURNS, turns.schema))
    turns = turns.select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))
    return chat_digests(read_back(format_conversations(turns)))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents"), piece_model()))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_decontaminate": op2_decontaminate,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_url_filter": op4_url_filter,
    "op5_quality_rules": op5_quality_rules,
    "op6_license_scan": op6_license_scan,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_html_text": op10_html_text,
    "op11_sharding": op11_sharding,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}
