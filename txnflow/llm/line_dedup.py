"""Line deduplication against levelled, sorted runs of line hashes.

The key of a line is the line without white space at both ends and with A-Z
lower-cased. A key of at least ``min_chars`` code points belongs to the
smallest document id that holds it; every other document loses its lines with
that key. Documents come in batches of ascending id. Each batch is joined with
the stored runs (a key found there is owned by an earlier document), keeps its
first holders of the rest, and adds those as a new run. When a level holds
``fanout`` runs they are merged into one run of the next level, so that a
batch meets only a logarithmic number of runs. Runs are bucketed by hash, so
only a batch's own keys are shuffled, however much is stored.

Defined cases: NULL or empty text is one empty line; a NULL id is one document
that comes after all others; rows that repeat an id are one document, and keep
or lose their lines alike; other columns pass through unchanged.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.llm.common import SPACE_CHARS, ascii_lower, row_struct, store, whole_text
from txnflow.session import new_folder

MIN_CHARS = 10
#: Batches a whole table is loaded in, and runs of a level before they are merged.
BATCHES = 4
FANOUT = 2

_KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _id(df: DataFrame) -> Column:
    """An id that sorts NULL last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))


class LineRuns:
    """The runs of line hashes in a shared folder, bucketed alike and sorted by the hashes.

    All runs of one store share a number of buckets, so looking a batch up and
    merging two runs join bucket with bucket: no stored hash is shuffled again.
    """

    def __init__(
        self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT, buckets: int | None = None
    ):
        self.spark, self.fanout = spark, fanout
        self.root = root or new_folder(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def stored(self) -> DataFrame | None:
        """(h1, h2, owner) of all lines seen so far; a key is in one run only."""
        runs = [self.spark.table(r) for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def with_owner(self, keys: DataFrame, owner_type: T.DataType) -> DataFrame:
        """``keys`` with the column owner: the earlier document that a run names, or NULL."""
        out = keys.withColumn("owner", F.lit(None).cast(owner_type))
        for run in (r for level in self.levels for r in level):
            held = self.spark.table(run).select(*_KEY, F.col("owner").alias("held"))
            out = out.join(held, _KEY, "left").withColumn("owner", F.coalesce("owner", "held")).drop("held")
        return out

    def _write(self, rows: DataFrame, level: int) -> None:
        run = f"line_run_{uuid.uuid4().hex}"
        writer = rows.select(*_KEY, "owner").write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY)
        writer.option("path", f"{self.root}/level-{level}/{run}").saveAsTable(run)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _merged(self, left: str, right: str) -> DataFrame:
        """One run of two that share no key."""
        a, b = self.spark.table(left), self.spark.table(right).withColumnRenamed("owner", "other")
        return a.join(b, _KEY, "full").withColumn("owner", F.coalesce("owner", "other"))

    def add(self, keys: DataFrame) -> None:
        """Add new keys as a run of the first level, and merge full levels."""
        self._write(keys.repartition(self.buckets, *_KEY), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            while len(self.levels[level]) > 1:
                pair = self.levels[level][:2]
                last = len(self.levels[level]) == 2
                self._write(self._merged(*pair), level + 1 if last else level)
                self.levels[level] = self.levels[level][2:]
                self._forget(pair)
            level += 1

    def _forget(self, runs: list[str]) -> None:
        """Drop names from the catalog; the files stay, as a lookup that was planned before may still read them."""
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def close(self) -> None:
        """Forget all runs."""
        self._forget([r for level in self.levels for r in level])
        self.levels = []


def line_hashes(docs: DataFrame) -> DataFrame:
    """(who, th, at, h1, h2) of every line that is long enough; two hashes make collisions a non-event."""
    text = whole_text(docs)
    keyed = docs.select(
        _id(docs).alias("who"), F.xxhash64(text).alias("th"), F.posexplode(lines_of(text)).alias("at", "line")
    ).select("who", "th", "at", line_key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= MIN_CHARS).select(
        "who", "th", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.col("key")).alias("h2")
    )


def load_batch(runs: LineRuns, docs: DataFrame) -> DataFrame:
    """(who, th, at) of the lines that a batch loses; the runs then hold its new keys.

    Ids of a batch must not be smaller than those of earlier batches.
    """
    lines = store(line_hashes(docs), "lines")
    own = lines.groupBy(*_KEY).agg(F.min("who").alias("first"), F.max("who").alias("last"))
    keys = store(runs.with_owner(own, own.schema["first"].dataType), "line-keys")
    runs.add(keys.where("owner is null").select(*_KEY, F.col("first").alias("owner")))
    shared = keys.where("owner is not null or not (first <=> last)").select(
        *_KEY, F.coalesce("owner", "first").alias("owner")
    )
    return lines.join(shared, _KEY).where("not (who <=> owner)").select("who", "th", "at")


def batches_of(docs: DataFrame, batches: int = BATCHES) -> list[DataFrame]:
    """Documents in ascending ranges of their numeric id with about equally many rows, NULL in the last.

    Any cut gives the same result, so the quantiles may be approximate. Rows of
    one id stay together.
    """
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, F.lit(10_000))).first()[0] if shares else None
    if not cuts:
        return [docs]
    cuts, who = sorted(set(cuts)), F.col("doc_id")
    middle = [docs.where((who > low) & (who <= high)) for low, high in pairwise(cuts)]
    return [docs.where(who <= cuts[0]), *middle, docs.where((who > cuts[-1]) | who.isNull())]


def dedup_lines(docs: DataFrame, runs: LineRuns | None = None, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the reduced ``text`` and the columns n_lines and n_dropped."""
    store_of = runs or LineRuns(docs.sparkSession)
    lost = [store(load_batch(store_of, part), "lost-lines") for part in batches_of(docs, batches)]
    if runs is None:
        store_of.close()
    per_text = (
        reduce(DataFrame.unionByName, lost)
        .groupBy("who", "th")
        .agg(F.collect_set("at").alias("_lost"))
        .select(F.col("who.id").alias("_id"), F.col("th").alias("_th"), "_lost")
    )
    text = whole_text(docs)
    # the row travels as one struct, so its names cannot meet the inner ones
    keep = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(row_struct(keep).alias("_row"), F.col("doc_id").alias("_doc"), text.alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    rows = rows.join(per_text, rows["_doc"].eqNullSafe(per_text["_id"]) & (rows["_hash"] == per_text["_th"]), "left")
    rows = rows.withColumn("_lines", lines_of(F.col("_text")))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_lost")), lambda i: F.col("_lines")[i]
    )
    done = rows.select(
        "_row",
        F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("_kept"),
        F.size("_lines").cast("long").alias("_all"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("_dropped"),
    )
    return done.select(
        "_row.*", F.col("_kept").alias("text"), F.col("_all").alias("n_lines"), F.col("_dropped").alias("n_dropped")
    )
