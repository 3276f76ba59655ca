"""Quality rules whose thresholds carry a guarantee.

Each rule is a score from 0 to 1000 (a share of the text in thousandths) that
rejects a document from a threshold on. Thresholds are chosen per stratum from
labelled documents: with ``k`` of ``n`` good holdout documents at or above a
threshold, the exact binomial tail ``P(Bin(n, risk) <= k)`` tests the
hypothesis that the rule rejects more than ``risk`` of the good documents. A
threshold is allowed only if that is refuted. All thresholds of a rule are one
sequence from the mildest on, tested until the first is not refuted, which
needs no correction; rules and strata share the error by Bonferroni. The risk
is shared by as many rules as the good labels of the stratum can support: with
few of them one rule, the one that gains most, has the whole risk. That number
follows from the count of labels alone, so it needs no correction either. So
with confidence ``1 - ERROR`` every stratum loses at most ``RISK`` of its good
documents to the rules. Among allowed thresholds the one that catches most bad
documents net of its cost in good ones is used.

A stratum whose good labels could not support even one rule is judged together
with the other ones of that kind: they form one stratum, and the guarantee holds
for their good documents taken together. Which ones these are follows from the
counts of labels alone. If all of them have too few labels there is no threshold.

The base rule (too few words, too many repeated ones) comes first and is not
part of the guarantee.

Defined cases: NULL or empty text has no words and fails the base rule; a NULL
stratum is a stratum of its own; unlabelled documents and labels that are NULL
do not count; a stratum without any label has no threshold; rows that repeat a document are judged alike; other columns pass
through unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm.common import SPACED_WORD, row_struct, store, whole_text

#: Share of good documents that the rules may reject in a stratum, and the chance to exceed it.
RISK, ERROR = 0.02, 0.05
#: Rejecting one good document outweighs catching this many bad ones.
COST = 10
#: Words in a window that is looked up again in the same text.
SPAN = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20

SYMBOL_CLASS = "[#*$%&|<>]"
#: rule: (count, whole); the score is 1000 * count / whole.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeated": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
}
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines"]


def _repeated_words(grams: str) -> Column:
    """Words under windows whose hash occurs twice; ``grams`` names the array of window hashes.

    Sorting brings equal windows together; of the sorted starts each covers up
    to the next one, at most ``SPAN`` words.
    """
    ordered = F.sort_array(F.transform(grams, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    starts = F.transform(
        F.array(ordered),  # binds the sorted array once
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    s, lambda e, k: e["x"].eqNullSafe(F.get(s, k - 1)["x"]) | e["x"].eqNullSafe(F.get(s, k + 1)["x"])
                ),
                lambda e: e["i"],
            )
        ),
    )[0]
    return starts


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of ``FEATURES``; one pass over each text, no shuffle.

    The row travels as one struct, so its names cannot meet the inner ones. The
    word hashes are bound once where windows are formed: read by name, they
    could be inlined, and each position would cut the text anew.
    """
    keep = [c for c in docs.columns if c not in FEATURES]
    out = docs.select(row_struct(keep).alias("_row"), whole_text(docs).alias("_text"))
    out = out.withColumn("_w", F.regexp_extract_all("_text", F.lit(SPACED_WORD), F.lit(0)))
    out = out.withColumn("_l", F.filter(F.split("_text", "\n"), lambda x: x.rlike(SPACED_WORD)))
    out = out.withColumn("_g", _windows(F.transform("_w", lambda x: F.xxhash64(x))))
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    out = out.withColumn("_s", F.when(repeats, _repeated_words("_g")).otherwise(F.array().cast("array<int>")))
    step = F.transform("_s", lambda x, k: F.least(F.lit(SPAN), F.coalesce(F.get("_s", k + 1) - x, F.lit(SPAN))))
    counts = {
        "n_words": F.size("_w"),
        "word_chars": F.length(F.array_join("_w", "")),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOL_CLASS)),
        "n_dup_lines": F.size("_l") - F.size(F.array_distinct("_l")),
        "n_repeat_words": F.aggregate(step, F.lit(0), lambda a, x: a + x),
        "n_capitals": F.regexp_count("_text", F.lit("[A-Z]")),
        "n_lines": F.size("_l"),
    }
    return out.select("_row.*", *(c.cast("long").alias(n) for n, c in counts.items()))


def _windows(hashes: Column) -> Column:
    """Hash of the ``SPAN`` words from each position on."""
    return F.transform(
        F.array(hashes),  # binds the array once
        lambda h: F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (SPAN - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, SPAN))),
        ),
    )[0]


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def scores() -> Column:
    """(rule, score) of every rule; a share of nothing is 0."""
    return F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                F.when(F.col(whole) > 0, F.least(F.lit(1000), F.floor(F.lit(1000) * F.col(count) / F.col(whole))))
                .otherwise(F.lit(0)).cast("int").alias("score"),
            )
            for rule, (count, whole) in RULES.items()
        )
    )


def _tail(k: Column, n: Column, risk: Column) -> Column:
    """P(Bin(n, risk) <= k), exact; from the median on it is at least 1/2 and refutes nothing."""
    first = n * F.log1p(-risk)
    odds = F.log(risk) - F.log1p(-risk)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        F.struct(first.alias("log"), F.exp(first).alias("sum")),
        lambda a, i: _step(a, a["log"] + F.log((n - i + 1) / i) + odds, i <= k),
        lambda a: a["sum"],
    )
    return F.when(k >= risk * n, F.lit(1.0)).otherwise(total)


def _step(a: Column, log: Column, use: Column) -> Column:
    return F.when(use, F.struct(log.alias("log"), (a["sum"] + F.exp(log)).alias("sum"))).otherwise(a)


def needed(rules: int, strata: int) -> float:
    """Good labels from which on a threshold that hits none of them is allowed, if ``rules`` share the risk."""
    return math.log(ERROR / (len(RULES) * max(strata, 1))) / math.log1p(-RISK / rules)


def pools(counts: DataFrame) -> DataFrame:
    """(stratum, pool): a stratum of enough good labels is its own pool, all others share the pool ``''``."""
    own = counts.where(F.col("rule") == next(iter(RULES))).groupBy("stratum").agg(F.sum("g").alias("n"))
    enough = F.col("n") >= needed(1, own.count())
    return store(own.select("stratum", F.when(enough, F.concat(F.lit("="), "stratum")).otherwise("").alias("pool")), "pools")


def thresholds(labelled: DataFrame, stratum: str = "lang") -> DataFrame:
    """(stratum, rule, threshold, good, rejected_good, rejected_bad, risk, tail) of the rules that are in force.

    ``labelled`` has the features and ``quality`` (1 good, 0 bad). Counts are
    by score, so a stratum of any size is at most 1001 rows for each rule. The
    figures of a stratum in the shared pool are those of the pool.
    """
    rows = labelled.where("quality in (0, 1)").where(~base_failed())
    rows = rows.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "quality", F.explode(scores()).alias("s"))
    counts = rows.groupBy("stratum", "s.rule", "s.score").agg(
        F.sum("quality").alias("g"), F.sum(1 - F.col("quality")).alias("b")
    )
    counts = store(counts, "score-counts")
    members = pools(counts)
    n_pools = members.select("pool").distinct().count()
    pooled = counts.join(members, "stratum").groupBy("pool", "rule", "score").agg(F.sum("g").alias("g"), F.sum("b").alias("b"))
    whole = Window.partitionBy("pool", "rule")
    above = whole.orderBy(F.desc("score"))
    tested = pooled.select(
        "pool", "rule", F.col("score").alias("threshold"), F.sum("g").over(whole).alias("good"),
        F.sum("g").over(above).alias("rejected_good"), F.sum("b").over(above).alias("rejected_bad"),
    )
    supported = sum((F.col("good") >= needed(m, n_pools)).cast("int") for m in range(1, len(RULES) + 1))
    tested = tested.where("threshold > 0").withColumn("sharing", F.greatest(supported, F.lit(1)))
    tested = tested.withColumn("risk", F.lit(RISK) / F.col("sharing"))
    tested = tested.withColumn("tail", _tail(F.col("rejected_good"), F.col("good"), F.col("risk")))
    allowed = tested.where(F.col("tail") <= ERROR / (len(RULES) * max(n_pools, 1)))
    gain = (F.col("rejected_bad") - COST * F.col("rejected_good")).alias("gain")
    best = F.max(F.struct(gain, *(c for c in tested.columns if c not in ("pool", "rule"))))
    chosen = allowed.groupBy("pool", "rule").agg(best.alias("x")).where("x.gain > 0").select("pool", "rule", "x.*")
    place = F.row_number().over(Window.partitionBy("pool").orderBy(F.desc("gain"), "rule"))
    chosen = chosen.withColumn("place", place).where("place <= sharing").drop("gain", "place", "sharing")
    return store(members.join(chosen, "pool").drop("pool"), "thresholds")


def judge(docs: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """Documents with features, judged: base_failed, broken (names of the rules they break) and kept.

    ``docs`` must be a stored table: a filter on the verdict is pushed down to
    whatever computes the features.
    """
    own = limits.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "threshold"))).alias("_limits"))
    keep = [c for c in docs.columns if c not in ("base_failed", "broken", "kept")]
    keyed = docs.select(
        row_struct(keep).alias("_row"), *FEATURES, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum")
    )
    joined = keyed.join(own.withColumnRenamed("stratum", "_own"), F.col("_stratum") == F.col("_own"), "left")
    broken = F.transform(
        F.filter(scores(), lambda s: F.coalesce(s["score"] >= F.try_element_at("_limits", s["rule"]), F.lit(False))),
        lambda s: s["rule"],
    )
    verdict = joined.select("_row", base_failed().alias("_base"), broken.alias("_broken"))
    return verdict.select(
        "_row.*",
        F.col("_base").alias("base_failed"),
        F.col("_broken").alias("broken"),
        (~F.col("_base") & (F.size("_broken") == 0)).alias("kept"),
    )


def holdout(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Measured documents with their label."""
    label = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return measured.drop("quality").join(label, "doc_id")


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, features and verdicts of every document, texts measured once."""
    measured = store(features(docs.select("doc_id", stratum, "text")).drop("text"), "measured")
    return judge(measured, thresholds(holdout(measured, labels), stratum), stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that are kept, unchanged.

    Rows are stored beside their features, one write without a shuffle; the
    thresholds read the features only, the verdict then filters stored rows.
    """
    whole = docs.select("doc_id", stratum, "text", row_struct(docs.columns).alias("_doc"))
    measured = store(features(whole).drop("text"), "measured")
    limits = thresholds(holdout(measured.select("doc_id", stratum, *FEATURES), labels), stratum)
    return judge(measured, limits, stratum).where("kept").select("_doc.*")
