"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard picked
by hash; documents of one group and hash class are one unit, so a group of any
size is at most ``PIECES`` units for each shard. In each round units are joined
with the votes of their group, the documents it has in each shard, and wish to
move to the shard with most votes that has room, preferably for the whole
group. Wishes are granted in an order of group size and hash as far as the
shard's quota reaches; the order is a histogram of bounded size, so no shard's
wishes are sorted in one task. Rounds end when nothing moves.

Then counts are made exact: documents without links, those whose wish was not
granted, and those above a shard's share fill the shards that lack some. Every shard has the same number of rows,
or one more. Ranks inside a shard come from counts per cell (``CELLS`` hash
classes of the rows) and row numbers inside a cell, so no task meets a whole
shard.

Defined cases: NULL text counts no bytes and has the checksum of the empty
text, and all such rows and those with an empty text are one group; rows that
repeat, or have no id, each get their own slot; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnflow.llm.common import store, whole_text

SHARDS = 24
#: Units of a group in one shard at the start, if it has that many documents.
PIECES = 4
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
MAX_ROUNDS = 12
#: Hash classes a round's wishes are granted by, within a class of group size.
GRANTS = 64
#: Rows aimed at in a cell; the number of cells stays between the bounds.
CELL_ROWS, LEAST_CELLS, MOST_CELLS = 100_000, 512, 8192


def manifest(docs: DataFrame) -> DataFrame:
    """(row, doc_id, size, text_crc32, h) of every document, stored: ``row`` is its number from then on."""
    text = whole_text(docs)
    return store(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "manifest",
    )


_GROUP = ["h", "text_crc32", "size"]


def units(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(group, bucket, weight, total, label) of the groups with several documents; the label is the shard."""
    cells = rows.groupBy(*_GROUP, _bucket(shards).alias("bucket")).agg(F.count(F.lit(1)).alias("weight"))
    # a group is at most PIECES * shards rows here
    groups = cells.groupBy(*_GROUP).agg(F.sum("weight").alias("total"), F.collect_list(F.struct("bucket", "weight")).alias("u"))
    linked = groups.where("total > 1").select(*_GROUP, "total", F.inline("u"))
    return store(linked.withColumn("label", F.col("bucket") % shards), "units")


def _bucket(shards: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(PIECES * shards)).cast("int")


def _wishes(state: DataFrame, free: list[int], turn: int) -> DataFrame:
    """``state`` with ``target``: the shard a unit wishes to move to, NULL where it stays.

    Of the shards where its group has documents, those with room for the rest
    of the group come first, then those with most votes; a hash of group and
    shard breaks ties alike for all units of the group.
    """
    votes = state.groupBy(*_GROUP, "label").agg(F.sum("weight").alias("n"))
    ballot = votes.groupBy(*_GROUP).agg(F.collect_list(F.struct("label", "n")).alias("votes"))
    room = lambda s: _listed(free, s)
    rank = lambda v: F.struct(
        ((F.col("total") - v["n"]) <= room(v["label"])).alias("whole"),
        v["n"].alias("n"),
        F.xxhash64(*_GROUP, v["label"]).alias("tie"),
        v["label"].alias("label"),
    )
    mine = F.filter("votes", lambda v: v["label"] == F.col("label"))[0]
    # the own shard has room for what is in it
    here = F.struct((F.col("total") - mine["n"] <= room(F.col("label"))).alias("whole"), mine["n"].alias("n"),
                    F.xxhash64(*_GROUP, "label").alias("tie"), F.col("label").alias("label"))
    able = F.filter("votes", lambda v: room(v["label"]) >= F.col("weight"))
    best = F.array_max(F.transform(able, rank))
    joined = state.join(ballot, _GROUP).withColumn("best", best).withColumn("here", here)
    target = F.when(F.col("best") > F.col("here"), F.col("best.label"))
    size_class = (F.lit(63) - F.floor(F.log2("total"))).cast("int")  # larger groups first
    # units that follow their whole group are granted together, those of a group that has to be split one by one
    apart = F.when(F.col("best.whole"), F.lit(-1)).otherwise(F.col("bucket"))
    turn_hash = F.pmod(F.xxhash64(*_GROUP, apart, F.lit(turn)), F.lit(GRANTS)).cast("int")
    return joined.select(*state.columns, target.alias("target"), (size_class * GRANTS + turn_hash).alias("turn"))


def propagate(state: DataFrame, capacity: int, shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """Units after the rounds; ``label`` is NULL where a unit could not join the rest of its group.

    Units that wish to stay are settled and use their shard's quota of
    ``capacity`` documents; wishes are granted from what is left of it. Units
    that wait use none, so full shards can still exchange their documents.
    """
    free, idle = [capacity] * shards, 0
    for turn in range(rounds):
        wished = store(_wishes(state, free, turn), "wishes")
        settled = dict(map(tuple, wished.where("target is null").groupBy("label").agg(F.sum("weight")).collect()))
        free = [max(0, capacity - settled.get(s, 0)) for s in range(shards)]
        asked = wished.where("target is not null").groupBy("target", "turn").agg(F.sum("weight").alias("asked"))
        # at most 64 * GRANTS rows a shard, however many units wish
        up_to = F.sum("asked").over(Window.partitionBy("target").orderBy("turn"))
        asked = asked.withColumn("up_to", up_to)
        fits = F.col("up_to") <= _listed(free, F.col("target"))
        best = asked.groupBy("target").agg(F.max(F.when(fits, F.struct("turn", "up_to"))).alias("x"))
        granted = {r["target"]: r["x"] for r in best.collect()}  # one for each shard
        last = [granted[s]["turn"] if granted.get(s) else -1 for s in range(shards)]
        free = [f - granted[s]["up_to"] if granted.get(s) else f for s, f in enumerate(free)]
        moves = F.col("turn") <= _listed(last, F.col("target"))
        label = F.when(F.col("target").isNull(), F.col("label")).when(moves, F.col("target"))
        idle = 0 if max(last) >= 0 else idle + 1
        done = not granted or idle == 2 or turn == rounds - 1
        state = wished.withColumn("label", label if done else F.coalesce(label, "label")).drop("target", "turn")
        state = store(state, "units")
        if done:
            break
    return state


def _listed(values: list[int], at: Column) -> Column:
    """The value of a shard, from a list of one for each."""
    return F.get(F.array(*(F.lit(v).cast("long") for v in values)), at)


def _even(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """(shard, slot) for rows with ``want`` (a shard, or NULL for any): counts at most one apart.

    Rows that want a shard stay in row order of cells up to its share. All
    others are numbered, and fill what the shards lack, shard after shard.
    """
    share = [n // shards + (s < n % shards) for s in range(shards)]
    cells = min(MOST_CELLS, max(LEAST_CELLS, n // CELL_ROWS))
    placed = rows.withColumns({
        "cell": F.pmod(F.xxhash64("row", F.lit(7)), F.lit(cells)).cast("int"), "want": F.coalesce("want", F.lit(shards)),
    })
    counts = placed.groupBy("want", "cell").agg(F.count(F.lit(1)).alias("k"))
    before = F.sum("k").over(Window.partitionBy("want").orderBy("cell")) - F.col("k")
    counts = store(counts.select("want", "cell", "k", before.alias("before")), "cells")
    load = dict(map(tuple, counts.groupBy("want").agg(F.sum("k")).collect()))  # one for each shard
    kept = [min(load.get(s, 0), share[s]) for s in range(shards)]
    spare = [load.get(s, 0) - kept[s] for s in range(shards)]
    # numbers of the rows that are free to go anywhere: unlinked ones first, then each shard's surplus
    first_spare = [load.get(shards, 0) + sum(spare[:s]) for s in range(shards)]
    lack_ends = [sum(share[: s + 1]) - sum(kept[: s + 1]) for s in range(shards)]

    at_cell = F.row_number().over(Window.partitionBy("want", "cell").orderBy("row")) - 1
    # at most MOST_CELLS rows for each shard: a table of some MB at any size of the corpus
    ranked = placed.withColumn("at", at_cell).join(F.broadcast(counts.drop("k")), ["want", "cell"])
    ranked = ranked.withColumn("rank", F.col("at") + F.col("before"))
    stays = F.coalesce(F.col("rank") < _listed(kept, F.col("want")), F.lit(False))
    number = F.when(F.col("want") == shards, F.col("rank")).otherwise(
        F.col("rank") - _listed(kept, F.col("want")) + _listed(first_spare, F.col("want"))
    )
    numbered = ranked.withColumn("free", F.when(~stays, number))
    goes = F.size(F.filter(F.array(*(F.lit(v).cast("long") for v in lack_ends)), lambda end: end <= F.col("free")))
    numbered = numbered.withColumn("shard", F.when(stays, F.col("want")).otherwise(goes))
    begins = [0, *lack_ends[:-1]]
    slot = F.when(stays, F.col("rank")).otherwise(
        F.col("free") - _listed(begins, F.col("shard")) + _listed(kept, F.col("shard"))
    )
    return numbered.withColumn("slot", slot).drop("want", "cell", "at", "before", "rank", "free")


def assign_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = MAX_ROUNDS) -> DataFrame:
    """(row, doc_id, size, text_crc32, h, shard, slot) of every document.

    Shards hold equally many rows, or one more; slots count from 0 in each;
    documents with equal texts share a shard as far as shares allow.
    """
    rows = manifest(docs)
    n = rows.count()
    linked = propagate(units(rows, shards), n // shards, shards, rounds)
    label = linked.select(*_GROUP, "bucket", F.col("label").alias("want"))
    wanted = store(rows.withColumn("bucket", _bucket(shards)).join(label, [*_GROUP, "bucket"], "left").drop("bucket"), "wanted")
    return _even(wanted, n, shards).select("row", "doc_id", "size", "text_crc32", "h", "shard", "slot")


def cut_documents(placed: DataFrame) -> DataFrame:
    """(documents, cut): linked documents, and those outside the shard with most of their group."""
    cells = placed.groupBy(*_GROUP, "shard").agg(F.count(F.lit(1)).alias("k"))
    groups = cells.groupBy(*_GROUP).agg(F.sum("k").alias("n"), F.max("k").alias("most")).where("n > 1")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return groups.agg(total(F.col("n")).alias("documents"), total(F.col("n") - F.col("most")).alias("cut"))
