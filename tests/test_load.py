"""Insert-or-ignore and the loader against plain loops over the same rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.operators import insert
from txnflow.operators import normalise as N
from txnflow.operators.constraints import check_reference, check_unique
from txnflow.operators.insert import first_per_key, insert_ignore, returning
from txnflow.operators.joins import denormalise
from txnflow.operators.project import to_staging
from txnflow.schema import RECORD_SCHEMA, TABLES
from txnflow.session import new_folder
from txnflow.session import stored as kept
from txnflow.sources.tables import read_table, scan_staging
from txnflow.streaming.load import load_batch

START = datetime(2019, 1, 1)


def txn(i, cust="A", street="1 Main St", merchant="M", category="X", minutes=None, **over):
    row = {
        "trans_date_trans_time": START + timedelta(minutes=i if minutes is None else minutes),
        "cc_num": f"40000{cust}",
        "merchant": merchant,
        "category": category,
        "amt": 10.0 + i,
        "first": "F" + cust,
        "last": "L" + cust,
        "gender": "F",
        "street": street,
        "city": "Town",
        "state": "ZZ",
        "zip": 12345,
        "lat": 1.0,
        "long": 2.0,
        "city_pop": 100,
        "job": "Cook",
        "dob": "1980-01-01",
        "trans_num": f"t{i:05d}",
        "unix_time": "0",
        "merch_lat": 0.0,
        "merch_long": 0.0,
        "is_fraud": False,
        **over,
    }
    return tuple(row[f.name] for f in RECORD_SCHEMA.fields)


def records(spark, rows):
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def staged(spark, rows):
    return to_staging(records(spark, rows))


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols or df.columns).collect())


# insert-or-ignore


def loop_insert(target, incoming, key_sets, order):
    """One row at a time, in order."""
    taken = [{tuple(r[k] for k in keys) for r in target} for keys in key_sets]
    added = []
    for r in sorted(incoming, key=lambda r: [r[c] for c in order]):
        keys = [tuple(r[k] for k in ks) for ks in key_sets]
        if any(k in t for k, t in zip(keys, taken) if None not in k):
            continue
        for k, t in zip(keys, taken):
            t.add(k)
        added.append(r)
    return added


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("two_keys", [False, True])
def test_insert_ignore_like_a_loop(spark, seed, two_keys):
    rng = random.Random(seed)

    def some(n, start):
        return [
            {"id": rng.randrange(12), "u": rng.choice([None, *range(12)]), "ts": rng.randrange(20), "n": start + i}
            for i in range(n)
        ]

    key_sets = [["id"], ["u"]] if two_keys else [["id"]]
    schema = "id long, u long, ts long, n long"
    target, incoming = some(4, 0), some(40, 100)
    got = insert_ignore(
        spark.createDataFrame(target, schema), spark.createDataFrame(incoming, schema), key_sets, ["ts", "n"]
    )
    want = loop_insert(target, incoming, key_sets, ["ts", "n"])
    assert rows_of(got, "n") == sorted((r["n"],) for r in want)


def test_two_key_insert_over_a_given_table_like_a_loop(spark):
    from txnflow.plans.feed import table
    from txnflow.plans.queries import insert_ignore_two_keys

    sf = "/root/testdata/sf0.001"
    got = insert_ignore_two_keys(spark, sf)
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_quantity").alias("label"),
        F.col("l_extendedprice").alias("price"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("part"),
    )
    want = loop_insert([], [r.asDict() for r in rows.collect()], [["id"], ["label"]], ["price", "part", "id", "label"])
    assert rows_of(got, "id", "label", "price") == sorted((r["id"], r["label"], r["price"]) for r in want)


def test_chained_conflicts_follow_the_order(spark):
    # r1 blocks r2 by u, so r3 may take the id r2 would have had
    df = spark.createDataFrame([("A", "X", 1), ("B", "X", 2), ("B", "Y", 3)], "id string, u string, o int")
    assert rows_of(insert_ignore(None, df, [["id"], ["u"]], ["o"]), "o") == [(1,), (3,)]


def test_null_primary_key_is_not_inserted(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "id string, o int")
    assert rows_of(insert_ignore(None, df, [["id"]], ["o"])) == [("a", 2)]


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan and "Window" not in plan


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_rare_copies_keep_the_same_rows(spark, monkeypatch, most):
    monkeypatch.setattr(insert, "MOST_REPEATED", most)
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(5)]), i) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, ts long, n long")
    assert set(insert.first_of_rare_copies(df, ["k"], ["ts"]).collect()) == set(first_per_key(df, ["k"], ["ts"]).collect())


def test_facts_that_do_not_repeat_are_not_shuffled(spark):
    rows = kept(staged(spark, [txn(i) for i in range(30)]))
    plan = N.load_transactions(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_close_facts_are_stored_once_and_not_shuffled(spark):
    from txnflow.plans.queries import fact_close_pairs

    plan = fact_close_pairs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "Exchange" not in plan


def test_earliest_keeps_what_can_come_first(spark):
    at = [None, START, START, START + timedelta(days=1)]
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.randrange(6), rng.choice(at), rng.randrange(9)) for _ in range(50)], "k long, ts timestamp, n long")
    few = insert.earliest(df, "k", "ts")
    assert set(first_per_key(few, ["k"], ["ts"]).collect()) == set(first_per_key(df, ["k"], ["ts"]).collect())
    assert few.count() < df.count()


def test_the_row_gate_aggregates_whole_rows_of_few(spark, monkeypatch):
    seen = []

    def counted(df, keys, order=()):
        seen.append(df.count())
        return first_per_key(df, keys, order)

    monkeypatch.setattr(N, "first_per_key", counted)
    rows = kept(staged(spark, [txn(i, street=f"{i % 5} St", merchant=f"M{i % 7}") for i in range(400)]))
    N.gate_by_row(rows)
    assert max(seen) <= 35


def test_ids_of_the_first_load_are_stored_sets(spark):
    from txnflow.plans.queries import known_rows

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60000")
    try:
        plan = known_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3


# loader scenarios: (first load, second load) and what the second one adds

BASE = [txn(1, "A", "1 Main St", "M", "X")]
SCENARIOS = {
    # name: (second load, gated customers, gated facts, complete facts)
    "all new": ([txn(2, "B", "2 Oak St", "N", "Y")], 1, 1, 1),
    "returning customer": ([txn(2, "A", "1 Main St", "M", "Y")], 0, 0, 1),
    "known bridge": ([txn(2, "B", "2 Oak St", "M", "X")], 1, 0, 1),
    "shared street": ([txn(2, "C", "1 Main St", "N", "Y")], 0, 0, 1),
    "replay": (BASE, 0, 0, 0),
    "duplicate in the load": ([txn(2, "B", "2 Oak St", "N", "Y")] * 2, 1, 1, 1),
}


@pytest.fixture(scope="module")
def base(spark):
    return N.load_tables(staged(spark, BASE))


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenarios(spark, base, name):
    second, gated_customers, gated_facts, complete_facts = SCENARIOS[name]
    rows = staged(spark, second)
    for grain in ("batch", "row"):
        gated = N.load_tables(rows, base, "gated", grain)
        assert gated["customer"].count() == gated_customers, grain
        assert gated["transactions"].count() == gated_facts, grain
    assert N.load_tables(rows, base)["transactions"].count() == complete_facts


def loop_gated(rows):
    """The row-by-row rule as a plain loop; returns the loaded transaction numbers."""
    bridges, addresses, customers, loaded = set(), set(), set(), []
    for r in sorted(rows, key=lambda r: (r["transaction_ts"], r["transaction_num"], r["id"])):
        new_bridge = r["merchant_category_id"] not in bridges
        new_address = r["address_id"] not in addresses
        new_customer = new_address and r["customer_id"] not in customers
        bridges.add(r["merchant_category_id"])
        addresses.add(r["address_id"])
        if new_customer:
            customers.add(r["customer_id"])
            if new_bridge:
                loaded.append(r["transaction_num"])
    return customers, sorted(loaded)


@pytest.mark.parametrize("seed", range(2))
def test_row_grain_like_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = staged(
        spark,
        [
            txn(i, rng.choice("ABCDEFGH"), f"{rng.randrange(8)} St", rng.choice("MNO"), rng.choice("XYZ"), rng.randrange(30))
            for i in range(60)
        ],
    )
    new = N.load_tables(rows, mode="gated", grain="row")
    customers, loaded = loop_gated([r.asDict() for r in rows.collect()])
    assert {r["id"] for r in new["customer"].collect()} == customers
    assert sorted(r["transaction_num"] for r in new["transactions"].collect()) == loaded


def test_first_write_wins_by_time(spark):
    rows = staged(spark, [txn(2, city_pop=200), txn(1, city_pop=300), txn(3, city_pop=100)])
    assert rows_of(N.load_city(N.buyer_rollup(rows)), "city_pop") == [(300,)]


def test_concat_collision_and_separator(spark):
    rows = [txn(1, merchant="ab", category="c"), txn(2, merchant="a", category="bc")]
    plain = N.load_merchant_category(to_staging(records(spark, rows)))
    apart = N.load_merchant_category(to_staging(records(spark, rows), sep="\u001f"))
    assert (plain.count(), apart.count()) == (1, 2)


def test_refused_customers_leave_no_orphans(spark):
    # the same customer under two texts of one birth date cannot be told apart by date;
    # the second id is refused and its facts stay out
    rows = staged(spark, [txn(1), txn(2)])
    odd = rows.withColumn(
        "customer_id", F.when(F.col("transaction_num") == "t00002", F.lit("other")).otherwise(F.col("customer_id"))
    )
    new = N.load_tables(odd)
    assert new["customer"].count() == 1
    assert rows_of(new["transactions"], "transaction_num") == [("t00001",)]
    assert check_reference(new["transactions"], "customer_id", new["customer"]).count() == 0


def test_rows_of_refused_customers_are_kept_as_orphans(spark):
    from txnflow.sources.tables import create_tables, scan_orphans
    from txnflow.streaming.load import load_staged

    root = new_folder(spark, "orphans")
    create_tables(spark, root)
    rows = staged(spark, [txn(1), txn(2), txn(3, "B")]).withColumn("violated", F.lit(None).cast("array<string>"))
    odd = rows.withColumn(
        "customer_id", F.when(F.col("transaction_num") == "t00002", F.lit("other")).otherwise(F.col("customer_id"))
    )
    odd.write.parquet(f"{root}/staging/load_id=o-0")
    for _ in range(2):  # again, as after a failure
        load_staged(spark, root, "o-0")
        assert rows_of(scan_orphans(spark, root), "transaction_num", "load_id") == [("t00002", "o-0")]
    assert rows_of(read_table(spark, root, "transactions"), "transaction_num") == [("t00001",), ("t00003",)]


# the stored model


def stored(spark, root):
    return {n: rows_of(read_table(spark, root, n), *t.columns) for n, t in TABLES.items()}


def many(seed, n=80):
    rng = random.Random(seed)
    return [
        txn(i, c := rng.choice("ABCDEFGHIJ"), f"{ord(c) % 4} St", rng.choice("MNOP"), rng.choice("XYZ"))
        for i in range(n)
    ]


def test_batches_add_up_and_replay_adds_nothing(spark):
    rows = many(1)
    whole, parts = new_folder(spark, "whole"), new_folder(spark, "parts")
    load_batch(records(spark, rows), whole, "w-0")
    for i in range(3):
        load_batch(records(spark, rows[i * 30 : (i + 1) * 30]), parts, f"p-{i}")
    first = stored(spark, parts)
    assert first == stored(spark, whole)

    load_batch(records(spark, rows[30:60]), parts, "p-1")  # the same batch again, as after a failure
    load_batch(records(spark, rows), parts, "q-0")  # everything again, as from a new checkpoint
    assert stored(spark, parts) == first

    tables = {n: read_table(spark, parts, n).select(*t.columns) for n, t in TABLES.items()}
    for name, t in TABLES.items():
        assert check_unique(tables[name], ["id"]).count() == 0
        assert check_unique(tables[name], t.unique).count() == 0
        for fk, parent in t.references.items():
            assert check_reference(tables[name], fk, tables[parent]).count() == 0
    expected = staged(spark, rows)
    assert rows_of(denormalise(tables), *expected.columns) == rows_of(expected)


def test_bad_rows_are_quarantined_with_reasons(spark):
    root = new_folder(spark, "bad")
    rows = [txn(1), txn(2, lat=95.0), txn(3, dob="1980-1-1"), txn(4, state="ZZZ"), txn(5, dob=None), txn(6, "B", lat=None)]
    load_batch(records(spark, rows), root, "b-0")
    assert rows_of(read_table(spark, root, "transactions"), "transaction_num") == [("t00001",), ("t00006",)]
    bad = {r["transaction_num"]: r["violated"] for r in scan_staging(spark, root, accepted=False).collect()}
    assert bad == {
        "t00002": ["range:lat"],
        "t00003": ["null:birth_date"],
        "t00004": ["length:state"],
        "t00005": ["null:birth_date", "null:customer_id"],
    }


def test_empty_batch_and_audit_columns(spark):
    root = new_folder(spark, "empty")
    load_batch(records(spark, []), root, "e-0")
    assert all(v == [] for v in stored(spark, root).values())
    load_batch(records(spark, [txn(1)]), root, "e-1")
    row = read_table(spark, root, "category").first()
    assert row["created_at"] is not None and row["created_at"] == row["updated_at"]


def test_returning_gives_the_new_ids(spark):
    rows = N.seller_rollup(staged(spark, BASE))
    assert returning(N.load_category(rows)).columns == ["id"]


def test_rows_in_reach_decide_like_the_whole_table(spark):
    from txnflow.operators import insert

    rng = random.Random(5)
    schema = "id long, u long, n long"
    some = lambda n, top: spark.createDataFrame([(rng.randrange(top), rng.randrange(top), i) for i in range(n)], schema)
    target, incoming = some(30, 60), some(30, 60)
    key_sets = [["id"], ["u"]]
    near = insert.in_reach(target, incoming, key_sets)
    assert rows_of(insert_ignore(near, incoming, key_sets, ["n"])) == rows_of(
        insert_ignore(target, incoming, key_sets, ["n"])
    )


def test_any_amount_loads_and_close_facts_stay_apart(spark):
    root = new_folder(spark, "amounts")
    amounts = [1e10, 1e12, 12345678901.5, float("nan"), float("inf"), 4.971, 4.974]
    at = [f.name for f in RECORD_SCHEMA.fields].index("amt")
    one = tuple(txn(1).values()) if isinstance(txn(1), dict) else tuple(txn(1))
    rows = [(*one[:at], a, *one[at + 1 :]) for a in amounts]
    load_batch(records(spark, rows), root, "a-0")
    kept = read_table(spark, root, "transactions").count()
    aside = scan_staging(spark, root, "a-0", accepted=False).collect()
    assert kept + len(aside) == len(amounts)
    assert all(v.endswith(":amount") for r in aside for v in r["violated"])


def test_two_key_insert_stores_each_value_once(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(insert, "stored", lambda df, label="keys": tables.append(kept(df, label)) or tables[-1])
    rows = spark.createDataFrame([(i // 2, i // 3, i) for i in range(60)], "id long, u long, n long")
    got = insert_ignore(None, rows, [["id"], ["u"]], ["n"])
    want = loop_insert([], [r.asDict() for r in rows.collect()], [["id"], ["u"]], ["n"])
    assert rows_of(got, "n") == sorted((r["n"],) for r in want)
    assert all(not isinstance(f.dataType, T.StructType) for t in tables for f in t.schema)
    # of the first round only the first row of each id is stored, and then only what it left open
    assert [t.count() for t in tables[:3]] == [60, 30, 30]


@pytest.mark.parametrize("seed", range(3))
def test_three_keys_with_nulls_like_a_loop(spark, seed):
    rng = random.Random(seed)
    some = lambda: rng.choice([None, *range(12)])
    rows = [{"id": some(), "u": some(), "v": some(), "w": some(), "n": n} for n in rng.sample(range(60), 60)]
    key_sets = [["id"], ["u"], ["v", "w"]]
    got = insert_ignore(None, spark.createDataFrame(rows, "id long, u long, v long, w long, n long"), key_sets, ["n"])
    want = loop_insert([], [r for r in rows if r["id"] is not None], key_sets, ["n"])
    assert rows_of(got, "n") == sorted((r["n"],) for r in want)
