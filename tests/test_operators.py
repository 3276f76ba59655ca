"""Frames, messages, constraints, profiling, order, projections, files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_coerce import GOOD, record, routed
from tests.test_load import records, rows_of, staged, txn
from txnflow.functions import text as X
from txnflow.operators import constraints as C
from txnflow.operators import frames, messages, ordering, profile, project
from txnflow.operators import joins
from txnflow.schema import RAW_SCHEMA, STAGING_COLUMNS
from txnflow.schema import CSV_SCHEMA
from txnflow.session import new_folder, stored
from txnflow.sinks import files
from txnflow.sinks.external import jdbc_options
from txnflow.sources import csv as csv_source
from txnflow.sources.kafka import kafka_options


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# frames and messages


def test_frame_round_trip_and_bad_headers(spark):
    df = spark.createDataFrame([(record(),)], "value string")
    framed = frames.encode_frame(df, 300)
    assert bytes(framed.first()["value"])[:5] == b"\x00\x00\x00\x01\x2c"
    assert bytes(frames.strip_frame(framed).first()["value"]).decode() == record()
    row = frames.split_frame(framed).first()
    assert (row["well_framed"], row["schema_id"]) == (True, 300)
    assert frames.decode_messages(framed, RAW_SCHEMA).first()["merchant"] == GOOD["merchant"]

    odd = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00\x07{}"),), (bytearray(b"\x00\x00"),), (None,)], "value binary")
    assert [r["well_framed"] for r in frames.split_frame(odd).collect()] == [False, False, False]


def test_unreadable_payload_gives_nulls(spark):
    df = spark.createDataFrame([(bytearray(b"not json"),)], "value binary")
    assert frames.flatten(frames.decode_payload(df, RAW_SCHEMA)).first()["cc_num"] is None


def test_keyed_message(spark):
    df = spark.createDataFrame([("1", "Bob", "bob@foo.com"), (None, "Eve", "e@x")], "id string, name string, email string")
    sent, refused = messages.encode_keyed_message(df, "id")
    row = sent.first()
    assert (row["key"], json.loads(row["value"])) == ("1", {"name": "Bob", "email": "bob@foo.com"})
    assert [r["name"] for r in refused.collect()] == ["Eve"]
    with pytest.raises(ValueError):
        messages.encode_keyed_message(df, "xxx")
    assert json.loads(messages.encode_message(df).first()["value"])["id"] == "1"


def test_delivery_time_is_utc(spark):
    df = spark.createDataFrame(
        [("test", 1, 2, 0.01, 6789578780976)], "topic string, partition int, offset long, latency double, timestamp_ms long"
    )
    assert messages.delivery_report(df).first()["produce_kafka_time"] == "2185-02-25 02:06:20.976000"
    assert messages.delivery_audit(df).first()["last_offset"] == 2


# constraints and profiling, small and large key sets alike


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; NULL keys too."""
    return spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") > 290, None).otherwise(F.col("id")).alias("k"), "id"
    )


def test_duplicated_rows(skewed):
    data = [(r["k"], r["id"]) for r in skewed.collect()]
    keys = [k for k, _ in data]
    want = sorted(i for k, i in data if keys.count(k) > 1)
    assert sorted(r["id"] for r in profile.duplicated_rows(skewed, ["k"]).collect()) == want


def test_check_reference(spark, skewed):
    parent = spark.range(10, 400)
    want = sorted(r["id"] for r in skewed.collect() if r["k"] is not None and r["k"] < 10)
    got = C.check_reference(skewed, "k", parent)
    assert sorted(r["id"] for r in got.collect()) == want


def test_stored_sets_are_joined_without_a_hint_or_a_single_partition(spark, skewed):
    keys = stored(skewed.select("k").distinct())
    plan = skewed.join(keys, "k", "left_semi")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "ResolvedHint" not in plan


def test_unique_and_dependency(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None), (None, 1), (None, 1)], "k string, v int")
    assert rows_of(C.check_unique(df, ["k"])) == [("a", 2), ("b", 2)]
    assert rows_of(profile.functional_dependency(df.dropna(subset=["k"]), ["k"], "v")) == [("a", 2)]


def test_distinct_counts_exact_and_approximate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 2)], "k string, v int")
    assert rows_of(profile.distinct_counts(df, ["k", "v"])) == [("k", 2), ("v", 2)]
    assert rows_of(profile.distinct_counts(df, ["k", "v"], approximate=True)) == [("k", 2), ("v", 2)]


def test_profile_and_shape(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    assert rows_of(profile.profile(df)) == [("k", 1, "string"), ("v", 2, "double")]
    assert tuple(profile.shape(df).first()) == (2, 2)


def test_range_edges_and_nulls(spark):
    df = spark.createDataFrame([(90.0, 180.0), (90.1, 0.0), (None, -180.0), (0.0, -180.1)], "lat double, long double")
    assert rows_of(C.check_range(df), "lat") == [(0.0,), (90.1,)]


# order


@pytest.mark.parametrize("copies", [1, 40])
def test_renumber_numbers_every_row_once(spark, copies):
    rng = [(k % 7 if k % 3 else 5,) for k in range(60)] * copies
    df = spark.createDataFrame([*rng, (None,)], "k int")
    got = [(r["row_no"], r["k"]) for r in ordering.renumber(df, ["k"]).collect()]
    want = sorted([k for (k,) in rng]) + [None]
    assert [k for _, k in sorted(got, key=lambda r: r[0])] == want
    assert sorted(n for n, _ in got) == list(range(len(rng) + 1))


def test_head_and_tail(spark):
    df = spark.createDataFrame([(i,) for i in [3, 1, None, 2]], "k int")
    assert [r["k"] for r in ordering.head(df, 2, ["k"]).collect()] == [1, 2]
    assert [r["k"] for r in ordering.tail(df, 2, ["k"]).collect()] == [3, None]
    assert [r["k"] for r in ordering.sort(df, ["k"]).collect()] == [1, 2, 3, None]
    assert "TakeOrderedAndProject" in plan(ordering.head(df, 2, ["k"]))


# projections and texts


def test_staging_row(spark):
    df = staged(spark, [txn(1, zip=7640)])
    assert df.columns == [new for new, _ in STAGING_COLUMNS]
    row = df.first()
    assert (row["zip"], row["city_id"], str(row["birth_date"])) == ("7640", "TownZZ", "1980-01-01")
    assert "Python" not in plan(df) and "Exchange" not in plan(df)


def test_ids_need_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        with pytest.raises(ValueError):
            project.create_id_cols(records(spark, [txn(1)]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project.drop_leading(df).columns == ["b", "c"]
    assert project.select_remaining(df, ["b"]).columns == ["a", "c"]
    assert project.select_keep(df, ["c", "a"]).columns == ["c", "a"]
    assert project.drop_columns(df, ["a"]).columns == ["b", "c"]
    assert project.columns_used({"x": {"a": "1", "b": "2"}, "y": {"b": "3"}}) == ["a", "b"]
    assert set(project.columns_used()) == {new for new, _ in STAGING_COLUMNS}


def test_texts(spark):
    row = spark.range(1).select(
        X.zip_text(F.lit(7640)).alias("a"),
        X.zip_text(F.lit(7640), pad=True).alias("b"),
        X.zip_text(F.lit(123456), pad=True).alias("c"),
        X.object_path(F.lit("t1"), F.lit("2024-01-02 03:04:05").cast("timestamp")).alias("d"),
        X.object_path(F.lit(None).cast("string"), F.lit("2024-01-02 03:04:05").cast("timestamp"), True).alias("e"),
        X.utf8_length(F.lit('{"key": "value"}')).alias("f"),
        X.drop_prefix(F.lit("fraud_X"), 6).alias("g"),
    ).first()
    assert tuple(row) == ("7640", "07640", "123456", "/20240102/0300/t1.txt", "/20240102/0300//None.txt", 16, "X")


def test_semi_and_anti_joins_keep_nulls_out(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("a",)], "id string")
    assert rows_of(joins.known_only(rows, "fk", parent)) == [("a",), ("a",)]
    assert rows_of(joins.not_stored(rows, "fk", parent)) == [("b",)]
    assert rows_of(joins.gated_by(rows, fk=parent)) == [("a",), ("a",)]


# files


def test_csv_readers(spark, tmp_path):
    header = "," + ",".join(GOOD)
    cells = ",".join(f'"{v}"' for v in GOOD.values())
    (tmp_path / "a.csv").write_text(f"{header}\n0,{cells}\n1,{cells[:-3]}\"2\"\n")
    typed = csv_source.read_csv_typed(spark, str(tmp_path)).collect()
    assert (typed[0]["amt"], typed[0]["is_fraud"], typed[0]["_c0"]) == (12.35, False, 0)
    assert typed[1]["is_fraud"] is None
    assert typed[0]["trans_date_trans_time"] == datetime(2019, 1, 1, 0, 0, 18)
    values = csv_source.read_csv_strings(spark, str(tmp_path))
    assert [r["route"] for r in routed(spark, [v["value"] for v in values.collect()]).collect()] == ["clean", "invalid"]
    assert dict(csv_source.read_csv_inferred(spark, str(tmp_path)).dtypes)["amt"] == "double"


def test_routes_are_written_in_one_pass_and_replaced(spark):
    root = new_folder(spark, "routed")
    values = [record(), record(is_fraud='"1"'), record(is_fraud='"2"'), "{"]
    for _ in range(2):
        files.route_sinks(routed(spark, values), root, "a-0")
    got = {r: [x["value"] for x in files.read_route(spark, root, r).collect()] for r in ("clean", "fraud", "invalid", "malformed")}
    assert {r: len(v) for r, v in got.items()} == {"clean": 1, "fraud": 1, "invalid": 1, "malformed": 1}
    assert json.loads(got["fraud"][0])["trans_date_trans_time"] == "2019-01-01 00:00:18"
    assert json.loads(got["invalid"][0])["errors"][0]["type"] == "bool_parsing"
    assert got["malformed"] == ["{"]


def test_json_objects_by_hour(spark):
    root = new_folder(spark, "objects")
    files.write_json_objects(records(spark, [txn(1), txn(90)]), root, F.col("trans_date_trans_time"))
    back = spark.read.schema("trans_num string, dt string, hh string").json(root)
    assert rows_of(back) == [("t00001", "20190101", "0000"), ("t00090", "20190101", "0100")]


def test_connector_options():
    options = kafka_options("broker:9092", "transactions", max_offsets=5)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5"
    assert jdbc_options("db", 5432, "cards", "staging.transactions", "u", "p")["url"] == "jdbc:postgresql://db:5432/cards"


def test_messages_without_a_key_are_an_error(spark):
    from txnflow.sinks.external import keyed_messages

    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    with pytest.raises(ValueError, match="key column"):
        keyed_messages(df, "k")
    assert keyed_messages(df.filter("k is not null"), "k").count() == 1 and keyed_messages(df, None).count() == 2


def test_csv_cells_with_quotes_commas_and_line_breaks(spark, tmp_path):
    header = ",".join(f.name for f in CSV_SCHEMA.fields)
    cells = {"job": '"say ""hi"", ok\nnext"', "dob": "1990-01-02", "is_fraud": "0", "amt": "1.5", "_c0": "1"}
    (tmp_path / "one.csv").write_text(header + "\n" + ",".join(cells.get(f.name, "x") for f in CSV_SCHEMA.fields) + "\n")
    for read in (csv_source.read_csv_typed, csv_source.read_csv_inferred):
        row = read(spark, str(tmp_path), multi_line=True).first()
        assert (row["job"], str(row["dob"]), row["amt"]) == ('say "hi", ok\nnext', "1990-01-02", 1.5)


def test_graceful_stop_on_an_endless_source(spark, tmp_path):
    import time

    from txnflow.streaming.start import start_sink, stop_gracefully

    query = start_sink(spark.readStream.format("rate").load(), lambda df, i: df.count(), str(tmp_path / "c"), "1 second")
    time.sleep(3)
    began = time.time()
    stop_gracefully(query)
    assert not query.isActive and time.time() - began < 10
