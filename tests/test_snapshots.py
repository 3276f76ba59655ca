"""Folded loads, the index of fact ids, committed routes, bounded batches, first-seen state, schemas by id."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_load import many, records, rows_of, stored, txn
from txnflow.operators import frames
from txnflow.operators.validate import attach_errors, validate_and_route
from txnflow.plans.feed import feed
from txnflow.schema import RECORD_SCHEMA, TABLES
from txnflow.session import configure, new_folder
from txnflow.sinks.files import by_hour, read_route, route_sinks, routed_payload
from txnflow.sources import csv as csv_source
from txnflow.sources import fact_index, snapshots
from txnflow.sources.tables import MONTH, compact, near_facts, read_table, scan_orphans
from txnflow.streaming.first_seen import start_first_seen
from txnflow.streaming import load
from txnflow.streaming.load import load_batch
from txnflow.streaming.messages import scan_aside, start_messages, stream_frames
from txnflow.streaming.start import start_sink, wait


def test_folding_changes_no_row_and_keeps_the_listing_short(spark):
    rows, root = many(4, 40), new_folder(spark, "model")
    for i in range(4):
        load_batch(records(spark, rows[i * 10 : i * 10 + 10]), root, f"b-{i}")
        before = stored(spark, root)
        snapshot = compact(spark, root, fan=2)
        assert stored(spark, root) == before
    # four folds with a fan of two: one segment of level 2
    assert [level for _, level in snapshot.segments] == [2] and snapshot.generation == 4
    assert all(f"{root.removeprefix('file:')}/gen-4" in f or "/segments/" in f for f in map(_path, read_table(spark, root, "city").inputFiles()))
    load_batch(records(spark, rows[10:20]), root, "b-1")  # a folded load again, as after a failure
    load_batch(records(spark, rows), root, "z-0")
    assert stored(spark, root) == before and scan_orphans(spark, root).count() == 0


def _path(uri):
    return uri.removeprefix("file://")


def test_a_fold_that_is_not_committed_is_not_seen(spark, monkeypatch):
    root = new_folder(spark, "model")
    load_batch(records(spark, many(5, 20)), root, "b-0")
    before = stored(spark, root)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr("txnflow.sources.tables.commit", fail)
        with pytest.raises(OSError):
            compact(spark, root)
    assert stored(spark, root) == before and snapshots.current(spark, root).version == 0
    compact(spark, root)
    assert stored(spark, root) == before


def test_the_index_finds_all_stored_ids_and_few_others(spark):
    ids = spark.range(20000).select(F.concat(F.lit("id"), "id").alias("id"), (F.col("id") % 3).cast("int").alias("ym"))
    index = fact_index.build(ids).withColumn("part", F.lit("a"))
    assert fact_index.maybe_stored(ids, index).count() == 20000
    others = ids.withColumn("id", F.concat("id", F.lit("x")))
    assert fact_index.maybe_stored(others, index).count() < 20000 * 0.1
    assert fact_index.maybe_stored(ids.withColumn("ym", F.lit(7)), index).count() == 0


def test_a_small_batch_does_not_shuffle_stored_facts(spark):
    root = new_folder(spark, "model")
    load_batch(records(spark, many(6, 40)), root, "b-0")
    facts = read_table(spark, root, "transactions")
    some = facts.limit(1).select("id", MONTH.name)
    months = [r[0] for r in facts.select(MONTH.name).distinct().collect()]
    near = near_facts(spark, root, "b-1", some, months)
    assert near.count() == 1
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    new = some.withColumn("id", F.lit("nobody has this id"))
    none = near_facts(spark, root, "b-1", new, months)
    assert none.count() == 0 and "FileScan" not in none._jdf.queryExecution().executedPlan().toString()


def test_new_facts_do_not_meet_stored_ones_by_a_join(spark):
    root = new_folder(spark, "model")
    load_batch(records(spark, many(6, 40)), root, "b-0")
    facts = read_table(spark, root, "transactions")
    months = [r[0] for r in facts.select(MONTH.name).distinct().collect()]
    new = facts.limit(1).select(F.lit("nobody has this id").alias("id"), MONTH.name)
    none = near_facts(spark, root, "b-1", new, months)
    plan = facts.join(none, "id", "left_anti")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and none.dtypes == facts.select(*TABLES["transactions"].columns).dtypes


def test_new_facts_beside_stored_ones_are_not_shuffled(spark, monkeypatch):
    root, rows, plans = new_folder(spark, "model"), many(6, 40), []
    load_batch(records(spark, rows[:20]), root, "b-0")
    write = load.write_delta
    keep = lambda name, delta, *a: plans.append((name, delta._jdf.queryExecution().executedPlan().toString())) or write(name, delta, *a)
    monkeypatch.setattr(load, "write_delta", keep)
    load_batch(records(spark, rows[10:]), root, "b-1")
    # the ids of near facts are a stored set, of known size: they are not looked for in this plan again
    assert "hashpartitioning" not in dict(plans)["transactions"] and "LeftSemi" not in dict(plans)["transactions"]
    assert read_table(spark, root, "transactions").count() == 40


def test_records_are_read_again_only_where_they_have_errors(spark):
    df = validate_and_route(spark.createDataFrame([('{"a":"1"}',), ("{",)], "value string"))
    kept = attach_errors(df, where=F.col("route") == "invalid").select("route", "payload").collect()
    assert {r["route"]: r["payload"] is None for r in kept} == {"invalid": False, "malformed": True}
    plan = routed_payload(df)._jdf.queryExecution().optimizedPlan().toString()
    assert all("CASE WHEN" in line.split("map_concat")[0] for line in plan.splitlines() if "map_concat" in line)


def test_shuffles_of_an_ended_query_are_not_kept(spark):
    configure(spark)
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    for i in range(4):
        assert len(spark.range(1000).groupBy(F.col("id") % 10).count().collect()) == 10
    assert files() <= before


def test_only_narrow_rows_are_shuffled_for_a_large_part_table(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.toString().splitlines()
    at = next(i for i, x in enumerate(lines) if "hashpartitioning(l_partkey" in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    under = [x for x in lines[at + 1 :] if len(x) - len(x.lstrip(" :+-")) > depth][:2]
    assert under and not any("c_name" in x for x in under)


def test_routes_keep_line_breaks_and_show_whole_loads_only(spark, monkeypatch):
    root = new_folder(spark, "routed")
    broken = ['{"a": 1,\n"b": ', '{\r\n\r"a"', "\n", "x\n\ny"]
    df = validate_and_route(spark.createDataFrame([(v,) for v in broken], "value string"))
    route_sinks(df, root, "l-0")
    assert sorted(r[0] for r in read_route(spark, root, "malformed").collect()) == sorted(broken)
    route_sinks(df, root, "l-0")  # repeated: the newer attempt counts
    assert read_route(spark, root, "malformed").count() == 4
    # an attempt that wrote its records and was lost before the marker
    lost = spark.createDataFrame([("half", "malformed", "20240101", "0500")], "value string, route string, dt string, hh string")
    lost.write.partitionBy("route", "dt", "hh").parquet(f"{root}/records/load_id=l-1/attempt=x")
    assert read_route(spark, root, "malformed").count() == 4


def test_routes_of_one_moment_are_not_brought_together(spark):
    rows = spark.range(8, numPartitions=4)
    moment = datetime(2024, 1, 1, 5, tzinfo=timezone.utc)
    same = by_hour(rows, moment)
    assert "REBALANCE" not in same._jdf.queryExecution().executedPlan().toString()
    assert same.select("dt", "hh").distinct().collect() == by_hour(rows, F.lit(moment)).select("dt", "hh").distinct().collect()
    assert same.first()["dt"] == "20240101" and same.first()["hh"] == "0500"


@pytest.mark.parametrize("files", [4, 8])
def test_bytes_bound_a_batch_so_more_input_makes_more_batches(spark, files):
    folder = new_folder(spark, "in")
    spark.range(files * 1000).selectExpr("concat('line ', id) as value").repartition(files).write.text(folder)
    size = max(os.path.getsize(_path(f)) for f in spark.read.text(folder).inputFiles())
    seen = []
    stream = csv_source.stream_records(spark, folder, bytes_per_trigger=2 * size)
    wait(start_sink(stream, lambda df, i: seen.append(df.count()), new_folder(spark, "check"), None))
    assert sum(seen) == files * 1000 and len(seen) == files // 2 and max(seen) <= 2100
    with pytest.raises(ValueError):
        csv_source.admission(1, 1)


def test_first_seen_state_is_bounded_and_late_rows_are_dropped(spark):
    folder, root, check = (new_folder(spark, n) for n in ("in", "seen", "check"))
    day = lambda k, d: (k, f"2024-01-{d:02d} 00:00:00")
    loads = [
        [day("a", 1), day("a", 1), day("b", 2), day("c", 10)],
        [day("b", 2), day("c", 9), day("late", 1), day("d", 9), day("e", 25)],
        [day("e", 25), day("d", 9), day("f", 26)],
    ]
    states, dropped = [], 0
    for load in loads:
        spark.createDataFrame(load, "id string, at string").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("id string, at string").parquet(folder).withColumn("at", F.to_timestamp("at"))
        query = start_first_seen(stream, root, check, ["id"], "at", "5 days", None)
        wait(query)
        states.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        dropped += sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
    kept = spark.read.parquet(root)
    assert sorted(r["id"] for r in kept.collect()) == ["a", "b", "c", "d", "e", "f"]
    assert dropped >= 3 and max(states) <= 4  # a and b are forgotten once the watermark passes them


READ = T.StructType().add("id", "integer").add("name", "string").add("price", "double")
WRITTEN = {
    1: T.StructType([*READ.fields, T.StructField("gone", T.StringType())]),
    2: T.StructType().add("id", "string").add("title", "string"),
}


def test_frames_are_decoded_by_the_schema_of_their_header(spark):
    rows = [
        (1, '{"id": 1, "name": "a", "price": 2.5, "gone": "x"}'),
        (2, '{"id": "2", "title": "b"}'),
        (3, '{"id": 3}'),
        (1, "{broken"),
    ]
    df = spark.createDataFrame(rows, "number int, value string")
    framed = frames.encode_frame(df, F.col("number")).select("value").union(spark.sql("SELECT unhex('01FF') UNION ALL SELECT CAST(NULL AS binary)"))
    got = frames.decode_by_schema(framed, WRITTEN, READ, {"price": 9.0}, {"name": ["title"]})
    assert rows_of(frames.decoded_records(got)) == [(1, "a", 2.5), (2, "b", 9.0)]
    aside = frames.frames_aside(got)
    assert sorted(r["reason"] for r in aside.collect()) == ["frame", "frame", "payload", "schema"]
    whole = {bytes(r["value"]) for r in aside.where("reason = 'schema'").collect()}
    assert whole == {b"\x00\x00\x00\x00\x03" + b'{"id": 3}'}


def test_a_payload_is_parsed_once_for_each_schema(spark):
    from txnflow.plans.queries import ALIASES, DEFAULTS, SCHEMAS

    framed = spark.createDataFrame([(b"x",)], "value binary")
    decoded = frames.decode_by_schema(framed, SCHEMAS, RECORD_SCHEMA, DEFAULTS, ALIASES)
    assert decoded._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == len(SCHEMAS)


def test_messages_of_one_file_each_reach_the_model(spark):
    from txnflow.plans.feed import as_text_fields
    from txnflow.plans.queries import ALIASES, DEFAULTS, SCHEMAS
    from txnflow.schema import FIELD_NAMES

    folder, root = new_folder(spark, "one"), new_folder(spark, "model")
    text = as_text_fields(records(spark, [txn(1), txn(2, "B")])).select(F.to_json(F.struct(*FIELD_NAMES)).alias("value"))
    sent = [bytes(r[0]) for r in frames.encode_frame(text, 7).collect()] + [b"\x00\x00\x00\x00\x4dzz", b"?"]
    os.makedirs(folder)
    for i, message in enumerate(sent):
        with open(f"{folder}/{i}.bin", "wb") as f:
            f.write(message)
    stream = stream_frames(spark, folder, files_per_trigger=3, fmt="binaryFile")
    wait(start_messages(stream, root, new_folder(spark, "check"), SCHEMAS, DEFAULTS, ALIASES, None))
    assert rows_of(read_table(spark, root, "transactions"), "transaction_num") == [("t00001",), ("t00002",)]
    assert rows_of(scan_aside(spark, root), "reason") == [("frame",), ("schema",)]
