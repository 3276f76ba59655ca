"""A stream of files gives what one batch gives, also after a restart."""

import glob

import pyarrow.parquet as pq
import pytest

from tests.test_coerce import record
from tests.test_load import many, records, stored, txn
from txnflow.plans import queries
from txnflow.plans.feed import as_text_fields
from txnflow.session import new_folder
from txnflow.sinks.files import read_route
from txnflow.operators.validate import validate_and_route
from txnflow.sources import csv as csv_source
from txnflow.sources.tables import read_table
from txnflow.streaming import start
from txnflow.streaming.first_seen import start_first_seen
from txnflow.streaming.load import load_batch
from txnflow.streaming.start import start_console, start_ingest, start_load, start_sink, stop_gracefully, wait
from pyspark.sql import functions as F


def write_csv(spark, rows, folder):
    text = as_text_fields(records(spark, rows)).select(F.lit("0").alias("_c0"), "*")
    text.coalesce(1).write.mode("append").option("header", True).csv(folder)


def test_stream_equals_batch_with_a_restart_half_way(spark):
    rows = many(3, 40)
    folder, root, check, whole = (new_folder(spark, n) for n in ("in", "model", "check", "whole"))

    def run(checkpoint):
        stream = csv_source.stream_csv_typed(spark, folder, 1).drop("_c0")
        query = start_load(stream, root, checkpoint, interval=None)
        assert wait(query, 300)
        return query

    write_csv(spark, rows[:20], folder)
    run(check)
    write_csv(spark, rows[20:], folder)
    run(check)
    load_batch(records(spark, rows), whole, "w-0")
    expected = stored(spark, whole)
    assert stored(spark, root) == expected
    run(check)  # nothing new
    run(new_folder(spark, "check"))  # everything again
    assert stored(spark, root) == expected


def test_ingest_routes_and_loads(spark):
    folder, root = new_folder(spark, "raw"), new_folder(spark, "model")
    values = [record(trans_num='"a"'), record(trans_num='"b"', is_fraud='"1"'), record(amt='"x"'), "{"]
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.text(folder)
    assert wait(start_ingest(csv_source.stream_records(spark, folder), root, new_folder(spark, "check"), None), 300)
    assert [t[1] for t in stored(spark, root)["transactions"]] == ["a"]
    counts = {r: read_route(spark, f"{root}/routed", r).count() for r in ("clean", "fraud", "invalid", "malformed")}
    assert counts == {"clean": 1, "fraud": 1, "invalid": 1, "malformed": 1}


def test_triggers_and_two_queries_on_one_source(spark):
    folder = new_folder(spark, "in")
    write_csv(spark, [txn(1)], folder)
    write_csv(spark, [txn(2)], folder)
    seen = []
    source = csv_source.stream_csv_typed(spark, folder, 1)
    sink = start_sink(source, lambda df, i: seen.append((i, df.count())), new_folder(spark, "check"), "1 second")
    console = start_console(source.select("trans_num"), "1 second", fmt="memory", name="seen_rows")
    try:
        assert not wait(sink, 1)
    finally:
        stop_gracefully(sink)
        stop_gracefully(console)
    assert seen == [(0, 1), (1, 1)]
    assert spark.table("seen_rows").count() == 2


def test_a_checkpoint_is_required(spark):
    with pytest.raises(TypeError):
        start_sink(spark.readStream.format("rate").load(), lambda df, i: None)


def test_tasks_can_share_the_files_of_message_load(spark, monkeypatch):
    files = []
    monkeypatch.setattr(queries, "PART_BYTES", 16 << 10)
    read = queries.message_streams.stream_frames
    monkeypatch.setattr(
        queries.message_streams, "stream_frames", lambda s, folder, **kw: files.extend(glob.glob(f"{folder}/*.parquet")) or read(s, folder, **kw)
    )
    queries.message_load(spark, "/root/testdata/sf0.001")
    parts = [pq.ParquetFile(f).num_row_groups for f in files if pq.ParquetFile(f).metadata.num_rows > 2000]
    assert parts and min(parts) > 1


def test_validation_is_built_once_and_not_for_every_batch(spark, monkeypatch):
    built = []
    monkeypatch.setattr(start, "validate_and_route", lambda df: built.append(df.isStreaming) or validate_and_route(df))
    folder, root = new_folder(spark, "raw"), new_folder(spark, "model")
    for part in ("a", "b"):
        spark.createDataFrame([(record(trans_num=f'"{part}"'),)], "value string").coalesce(1).write.mode("append").text(folder)
    query = start_ingest(csv_source.stream_records(spark, folder, 1), root, new_folder(spark, "check"), None)
    assert wait(query, 300)
    assert built == [True] and {r["transaction_num"] for r in read_table(spark, root, "transactions").collect()} == {"a", "b"}


@pytest.mark.parametrize("name", ["stream_load", "stream_replay", "csv_strings"])
def test_compressed_input_has_files_for_many_tasks(spark, monkeypatch, name):
    made, folder = {}, queries.new_folder
    monkeypatch.setattr(queries, "FILE_RECORDS", 500)
    monkeypatch.setattr(queries, "new_folder", lambda s, label: made.setdefault(label, folder(s, label)))
    queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(glob.glob(f"{made.get('raw') or made['csv']}/*.gz")) >= 11


def test_state_rows_are_counted_only_if_asked_for(spark):
    folder = new_folder(spark, "in")
    spark.range(20).select("id", F.timestamp_seconds(F.col("id") + 1).alias("at")).write.parquet(folder)
    counted = []
    for count in (False, True):
        stream = spark.readStream.schema("id long, at timestamp").parquet(folder)
        root, check = new_folder(spark, "seen"), new_folder(spark, "check")
        query = start_first_seen(stream, root, check, ["id"], "at", "1 day", None, count_rows=count)
        assert wait(query, 300)
        assert spark.read.parquet(root).count() == 20
        counted.append(query.recentProgress[0]["stateOperators"][0]["numRowsTotal"])
    assert counted[1] == 20 and counted[0] != 20
