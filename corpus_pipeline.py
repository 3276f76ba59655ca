"""A corpus clean-up in five stages; each is written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnflow.llm.common import table
from txnflow.llm.decontaminate import drop_contaminated
from txnflow.llm.jaccard_join import keep_one
from txnflow.llm.line_dedup import dedup_lines
from txnflow.llm.quality_rules import keep_good
from txnflow.llm.queries import piece_model
from txnflow.llm.sentencepiece_bpe import digests, encode
from txnflow.session import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one holds; n_chars stays that of the source."""
    return dedup_lines(docs).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return digests(encode(docs, piece_model()))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", sentencepiece),
]

#: SQL has no SentencePiece; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
