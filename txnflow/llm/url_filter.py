"""URL filter: rules for hosts and paths first, then a weighted vocabulary.

The longest rule that fits a host (or a parent domain) and the start of the
path decides. Without one, an Aho-Corasick automaton finds all terms of the
vocabulary in the lower-cased url at once; a hit counts only between letters'
and digits' boundaries. One strict term blocks, or several distinct soft ones.

Defined cases: a NULL url, or one without ``://``, has an empty host and path
and fits no rule; its whole text is still searched; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import ascii_lower, row_struct
from txnflow.llm.common import column as named

# fixed values: the rules of the contract
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Terms and weights; a url is blocked from a weight of ``BLOCK`` on.
STRICT = ["casino", "porn", "xxx", "viagra", "warez", "escort", "malware", "phishing"]
SOFT = ["adult", "ads", "bet", "bets", "cheap", "click", "farm", "free", "pills", "promo", "spam", "track", "win", "x"]
STRICT_WEIGHT, SOFT_WEIGHT, BLOCK = 2, 1, 2


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(verdict, rule) of the longest rule that fits, or NULL."""
    out = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def count_terms(df: DataFrame, column: str, strict: Sequence[str], soft: Sequence[str]) -> DataFrame:
    """``df`` with the columns strict_terms and soft_terms: distinct terms found in ``column``, sorted."""
    keep = [c for c in df.columns if c not in ("strict_terms", "soft_terms")]
    names = [*keep, "strict_terms", "soft_terms"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for terms, hard in ((soft, False), (strict, True)):
            for t in terms:
                automaton.add_word(t, (t, hard))
        automaton.make_automaton()

        def plain(c: str) -> bool:
            return "a" <= c <= "z" or "0" <= c <= "9"

        def found(text: str) -> tuple[list[str], list[str]]:
            hits: tuple[set[str], set[str]] = (set(), set())
            for end, (term, hard) in automaton.iter(text):
                start = end - len(term)
                if (start < 0 or not plain(text[start])) and (end + 1 == len(text) or not plain(text[end + 1])):
                    hits[not hard].add(term)
            return sorted(hits[0]), sorted(hits[1])

        for batch in batches:
            both = [found(u or "") for u in batch.column(column).to_pylist()]
            lists = [pa.array([b[i] for b in both], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *lists], names)

    made = T.StructType.fromDDL("strict_terms array<string>, soft_terms array<string>")
    source = df.select(*(named(c) for c in keep))
    return source.mapInArrow(task, T.StructType([*source.schema.fields, *made.fields]))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = tuple(RULES),
    strict: Sequence[str] = tuple(STRICT),
    soft: Sequence[str] = tuple(SOFT),
) -> DataFrame:
    """``pages`` with host, path, rule, strict_terms, soft_terms and verdict."""
    made = ["host", "path", "rule", "strict_terms", "soft_terms", "verdict"]
    whole = pages.select(row_struct(pages.columns).alias("_page"), F.coalesce(F.col("url"), F.lit("")).alias("_url"))
    whole = whole.withColumn("_low", ascii_lower(F.col("_url")))
    out = count_terms(whole, "_low", strict, soft)
    out = out.withColumn("host", url_host(F.col("_url"))).withColumn("path", url_path(F.col("_url")))
    out = out.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    weight = STRICT_WEIGHT * F.size("strict_terms") + SOFT_WEIGHT * F.size("soft_terms")
    out = out.withColumn("rule", F.col("_rule.rule")).withColumn(
        "verdict", F.coalesce("_rule.verdict", F.when(weight >= BLOCK, "block").otherwise("allow"))
    )
    return out.select(*(F.col("_page")[c].alias(c) for c in pages.columns if c not in made), *made)
