"""License scan by diagonal voting.

All runs of ``K`` words of every document are joined to the positions of the
same run in short license notices. A hit at document word ``p`` and template
word ``q`` votes for the diagonal ``p - q``; votes are counted per document,
template and diagonal. Neighbouring diagonals (words put in or left out)
become one span, which is reported if it covers enough of the template and is
not much longer. The join compares the words themselves after their hash, so
no hit rests on a hash alone. Fixed phrases are counted beside it.

The only broadcast table is that of the templates, whose size is checked.

Defined cases: NULL or empty text has no words and no label; rows that repeat
a document get the same labels; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnflow.llm.common import LETTER_WORD, ascii_lower, whole_text

K = 3
#: Diagonals this close are one span; a span must cover this share and be at most this many times as long.
SLACK, MIN_COVER, MAX_STRETCH = 3, 0.6, 1.5
MAX_TEMPLATE_ROWS = 100_000

# fixed values: phrases and labels of the contract
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: opening words of public license notices
TEMPLATES = {
    "agpl-3.0": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(LETTER_WORD), F.lit(0))


def _grams(words: str) -> Column:
    """Runs of K words by position; none for fewer words."""
    starts = F.slice(words, 1, F.greatest(F.size(words) - (K - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.concat_ws(" ", x, *(F.col(words)[i + j] for j in range(1, K))))


def template_rows(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """(label, size, q, gram, h) for every position of every template."""
    rows = spark.createDataFrame(sorted(templates.items()), "label string, text string")
    rows = rows.select("label", words_of(F.col("text")).alias("w"))
    rows = rows.select("label", (F.size("w") - (K - 1)).alias("size"), F.posexplode(_grams("w")).alias("q", "gram"))
    return rows.withColumn("h", F.xxhash64("gram"))


def template_spans(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, th, label, first_word, last_word, score): verified spans of templates."""
    if sum(len(t.split()) for t in templates.values()) > MAX_TEMPLATE_ROWS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_ROWS} words are too large to broadcast")
    text = whole_text(docs)
    key = ["doc_id", "th"]
    worded = docs.select("doc_id", F.xxhash64(text).alias("th"), words_of(text).alias("w"))
    runs = worded.select(*key, F.posexplode(_grams("w")).alias("p", "run"))
    marks = F.broadcast(template_rows(docs.sparkSession, templates))
    hits = runs.join(marks, (F.xxhash64(runs["run"]) == marks["h"]) & (runs["run"] == marks["gram"]))
    hits = hits.select(*key, "label", "size", (F.col("p") - F.col("q")).alias("diagonal"), "p", "q").distinct()
    votes = hits.groupBy(*key, "label", "size", "diagonal").agg(
        F.min("p").alias("low"), F.max("p").alias("high"), F.collect_set("q").alias("qs")
    )
    line = Window.partitionBy(*key, "label").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(line) > SLACK, F.lit(True))
    spans = votes.withColumn("fresh", fresh.cast("int"))
    spans = spans.withColumn("span", F.sum("fresh").over(line)).groupBy(*key, "label", "size", "span").agg(
        F.min("low").alias("first_word"), (F.max("high") + (K - 1)).alias("last_word"),
        F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("met"),
    )
    score = (F.col("met") / F.col("size")).alias("score")
    long_ = F.col("last_word") - F.col("first_word") + 1 > MAX_STRETCH * (F.col("size") + K - 1)
    return spans.where((F.col("met") >= MIN_COVER * F.col("size")) & ~long_).select(
        *key, "label", "first_word", "last_word", score
    )


def _places(phrase: str) -> Column:
    """Start words of a phrase in the array ``w``, found by search before words are compared."""
    parts = phrase.split()
    at = F.sequence(F.lit(0), F.size("w") - len(parts))

    def here(i: Column) -> Column:
        same = F.lit(True)
        for j, part in enumerate(parts):
            same = same & (F.col("w")[i + j] == part)
        return same

    return F.when(F.contains("joined", F.lit(f" {phrase} ")), F.filter(at, here)).otherwise(F.array().cast("array<int>"))


def phrase_places(docs: DataFrame, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """(doc_id, th, n_words, starts, base): all start words of the phrases, and the labels of those found."""
    text = whole_text(docs)
    rows = docs.select("doc_id", F.xxhash64(text).alias("th"), words_of(text).alias("w"))
    rows = rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")))
    rows = rows.select("doc_id", "th", F.size("w").alias("n_words"), F.array(*map(_places, phrases)).alias("places"))
    labels = F.array(*map(F.lit, phrases.values()))
    found = F.filter(labels, lambda x, i: F.size(F.col("places")[i]) > 0)
    return rows.select("doc_id", "th", "n_words", F.flatten("places").alias("starts"), F.array_distinct(found).alias("base"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, starts, base, templates (labels) and score (the best span's)."""
    found = template_spans(docs).groupBy("doc_id", "th").agg(
        F.collect_set("label").alias("templates"), F.max("score").alias("score")
    )
    rows, found = phrase_places(docs).alias("r"), found.alias("f")
    same = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.th") == F.col("f.th"))
    return rows.join(found, same, "left").select(
        "r.doc_id", "r.n_words", "r.starts", "r.base",
        F.coalesce("f.templates", F.array().cast("array<string>")).alias("templates"),
        F.coalesce("f.score", F.lit(0.0)).alias("score"),
    )
