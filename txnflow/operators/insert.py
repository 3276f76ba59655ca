"""INSERT ... ON CONFLICT DO NOTHING as set operations: the first write wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import all_of, stored


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties by the other columns.

    An aggregate, not a window: every task reduces its own rows first, so a key
    that holds a third of all rows still sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + rest
    if not ranked:
        return df.select(*keys).distinct()
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return firsts.select(*keys, "_first.*").select(*df.columns)


def earliest(df: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of each key (not NULL) at its earliest time; no time comes before any.

    Where a key has many rows this keeps few of them, and only keys and times are aggregated: a
    hash aggregate, whereas the least of whole rows sorts all of them.
    ``df`` is read twice, so it should be a stored table.
    """
    time = F.coalesce(F.unix_micros(at), F.lit(-(2**63))).alias("_at")
    least = stored(df.groupBy(key).agg(F.min(time).alias("_at")), "earliest")
    return df.select("*", time).join(least, [key, "_at"], "left_semi").select(*df.columns)


#: At most so many repeated keys are kept apart; their hashes are a stored set of about 8 MB.
MOST_REPEATED = 1_000_000


def first_of_rare_copies(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``first_per_key`` for keys that seldom repeat: only rows whose key may repeat are shuffled whole.

    The hashes of the keys are counted first, eight bytes a row. A row whose
    hash occurs once is the only one of its key. Where more keys repeat than
    ``MOST_REPEATED``, all rows take the plain way. ``df`` is read twice, so it
    should be a stored table.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    counts = df.select(hashed).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = stored(counts.where("_n > 1").select("_hash"), "repeated")
    n = repeated.count()
    if n == 0:
        return df
    if n > MOST_REPEATED:
        return first_per_key(df, keys, order)
    rows = df.select("*", hashed)
    firsts = first_per_key(rows.join(repeated, "_hash", "left_semi").select(*df.columns), keys, order)
    return rows.join(repeated, "_hash", "left_anti").select(*df.columns).unionByName(firsts)


def _anti(rows: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(present.select(*keys), list(keys), "left_anti")


def in_reach(target: DataFrame, incoming: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """The rows of ``target`` that share a key with ``incoming``; a row may occur once per key set.

    All an insert needs of a large table when little comes in: the incoming
    keys are stored, and where they are few Spark broadcasts them and scans the
    table where it lies.
    """
    hits = [target.join(stored(incoming.select(*keys).distinct()), list(keys), "left_semi") for keys in key_sets]
    return reduce(DataFrame.unionByName, [h.select(*target.columns) for h in hits])


def insert_ignore(
    target: DataFrame | None,
    incoming: DataFrame,
    key_sets: Sequence[Sequence[str]],
    order: Sequence[str] = (),
    rare_copies: bool = False,
) -> DataFrame:
    """The rows of ``incoming`` that an insert-or-ignore into ``target`` would add.

    Rows are taken in ``order``; a row enters if none of its keys is taken, by
    the target or by a row that entered before. The first key set is the
    primary key: rows with a NULL in it are not inserted. In the others NULL
    conflicts with nothing.

    With one key set this is one lazy aggregation; with ``rare_copies`` (see
    ``first_of_rare_copies``) only the rows of repeated keys are aggregated. With more, whether a row
    enters depends on whether earlier ones did, so it is decided in rounds: in
    each one the rows that come first under all of their keys enter, and the
    rows in conflict with them leave. A round stores the first row of each primary
    key, marked whether it enters, and the rows still open: those of a primary key
    whose first row did not, without the ones that another key rules out. One
    round is enough unless conflicts chain; every round settles at least one row.
    """
    rows = incoming.filter(all_of([F.col(k).isNotNull() for k in key_sets[0]]))
    every_key = list(dict.fromkeys(k for keys in key_sets for k in keys))
    if len(key_sets) == 1 or target is not None:
        # Of rows equal in all keys only the first can ever enter. This comes before
        # the join with the target, so copies are combined before any shuffle, and
        # the join finds the rows already partitioned by the primary key.
        rows = (first_of_rare_copies if rare_copies else first_per_key)(rows, every_key, order)
    if target is not None:
        for keys in key_sets:
            rows = _anti(rows, target, keys)
    if len(key_sets) == 1:
        return rows

    ranked = [*[c for c in order if c not in every_key], *[c for c in rows.columns if c not in order], *every_key]
    pending = stored(rows, "pending")
    entered: list[DataFrame] = []
    while True:
        firsts = stored(_mark_firsts(pending, key_sets, list(dict.fromkeys(ranked))), "firsts")
        entering, blocked = firsts.where("_first"), firsts.where("not _first")
        entered.append(entering)
        if (open_keys := not blocked.isEmpty()):
            # a primary key is settled if its first row enters, so few keys are looked for and not the many settled ones
            rest = pending.join(blocked.select(*key_sets[0]), list(key_sets[0]), "left_semi")
            for keys in key_sets[1:]:
                rest = _anti(rest, entering, keys)
            pending = stored(rest, "pending")
        if not open_keys or pending.isEmpty():
            return reduce(DataFrame.unionByName, entered).select(*incoming.columns)


def _mark_firsts(pending: DataFrame, key_sets: Sequence[Sequence[str]], ranked: Sequence[str]) -> DataFrame:
    """The first row of each primary key, with ``_first``: it is also the first of all its other keys.

    Each key set has one aggregation over whole rows, which combines before its
    shuffle. Of the other firsts only the keys are joined: they tell a row, as
    of rows equal in all keys both aggregations see the first.
    """
    out, first = first_per_key(pending, key_sets[0], ranked).select(*pending.columns), F.lit(True)
    every_key = list(dict.fromkeys(k for keys in key_sets for k in keys))
    for i, keys in enumerate(key_sets[1:]):
        given = all_of([F.col(k).isNotNull() for k in keys])
        best = first_per_key(pending.where(given), keys, ranked)
        best = best.select(*[F.col(k).alias(f"_{i}_{k}") for k in every_key], F.lit(True).alias(f"_hit{i}"))
        known = {*key_sets[0], *keys}  # not NULL here, so these are plain join keys
        same = [F.col(k) == F.col(f"_{i}_{k}") if k in known else F.col(k).eqNullSafe(F.col(f"_{i}_{k}")) for k in every_key]
        out = out.join(best, all_of(same), "left")
        first = first & (~given | F.col(f"_hit{i}").isNotNull())
    return out.select(*pending.columns, first.alias("_first"))


def returning(delta: DataFrame) -> DataFrame:
    """The ids added by an insert, as a stored relation for later steps."""
    return stored(delta.select("id"), "returned")


def append(target: DataFrame, delta: DataFrame) -> DataFrame:
    return target.unionByName(delta)
