"""Named queries over the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnflow.functions import text as X
from txnflow.functions.ids import register_sql_functions
from txnflow.operators import constraints as C
from txnflow.operators import frames, messages, ordering, profile
from txnflow.operators import normalise as N
from txnflow.operators import validate as V
from txnflow.operators.insert import append, insert_ignore, returning
from txnflow.operators.joins import denormalise, known_only, not_stored
from txnflow.operators.project import columns_used, create_id_cols, drop_columns, drop_leading, select_remaining, to_staging
from txnflow.plans.feed import as_text_fields, dirty_feed, feed, raw_feed, table
from txnflow.schema import FIELD_NAMES, RAW_SCHEMA, RECORD_SCHEMA, TABLES
from txnflow.session import configure, new_folder, stored
from txnflow.sinks.files import read_route, route_sinks, write_json_objects
from txnflow.sources import csv as csv_source
from txnflow.sources.tables import compact, create_tables, read_table, scan_ids, scan_orphans, scan_staging
from txnflow.streaming import messages as message_streams
from txnflow.streaming.first_seen import start_first_seen
from txnflow.streaming.load import load_batch, load_staged, write_staging
from txnflow.streaming.start import start_ingest, start_load, wait

# Rows before this time are the earlier load in the queries with two loads.
FIRST_LOAD_ENDS = "1995-01-15 00:00:00"
SECOND_LOAD_ENDS = "1997-01-15 00:00:00"
SCHEMA_ID = 7
#: Files of about so many bytes make a micro-batch, however many wait.
BATCH_BYTES = 64 << 20
#: Parts of so many bytes are what tasks can share of a file, so a micro-batch of few files has many tasks.
PART_BYTES = 2 << 20
#: A compressed file is read by one task, so files of so many records give a micro-batch many tasks.
FILE_RECORDS = 20_000


def clean_feed(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf).filter(~F.col("is_fraud"))


def staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staging rows as one lazy projection."""
    return to_staging(clean_feed(spark, sf))


def staging_table(spark: SparkSession, sf: str) -> DataFrame:
    """Staging rows as the loader sees them: a stored table.

    The model queries read it several times, each time other columns, and
    filter on ids; on the lazy rows every such filter would hash the names again.
    """
    root = new_folder(spark, "model")
    configure(spark)
    write_staging(clean_feed(spark, sf), root, "only")
    return scan_staging(spark, root, "only")


def _naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    zoned = [name for name, dtype in df.dtypes if dtype == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


# ids and projections


def ids_all(spark, sf):
    ids = create_id_cols(feed(spark, sf))
    return ids.select(
        "trans_num",
        "city_id",
        "address_id",
        "customer_id",
        "merchant_id",
        "category_id",
        "merchant_category_id",
        "transaction_id",
    )


def ids_sql(spark, sf):
    """The same ids from SQL text, and the constant id of a missing name."""
    register_sql_functions(spark)
    feed(spark, sf).createOrReplaceTempView("txnflow_feed")
    return spark.sql("""
        SELECT trans_num,
               uuid5_oid(concat(first, last, dob, cc_num)) AS customer_id,
               create_deterministic_uuid(concat(merchant, category)) AS merchant_category_id,
               create_deterministic_uuid(concat(street, if(is_fraud, NULL, ''))) AS address_or_none
        FROM txnflow_feed""")


def ids_separated(spark, sf):
    ids = create_id_cols(feed(spark, sf), sep="\u001f")
    return ids.select("trans_num", "city_id", "customer_id", "merchant_category_id")


def staging_rows(spark, sf):
    return _naive(staging(spark, sf))


def used_and_left(spark, sf):
    """Columns the tables use, then what is left of the record without the dropped ones."""
    rows = feed(spark, sf)
    sources = {"category": {"category": "category"}, "city": {"city": "city_name", "state": "state"}}
    left = drop_columns(select_remaining(rows, columns_used(sources)), ["merch_lat", "merch_long", "unix_time"])
    return drop_leading(left, 1)


def scalar_texts(spark, sf):
    c = F.col
    at = c("trans_date_trans_time")
    return feed(spark, sf).select(
        "trans_num",
        X.drop_prefix(c("merchant"), 6).alias("merchant_name"),
        X.comma_pair(c("lat"), c("long")).alias("coord"),
        X.comma_pair(c("first"), c("last")).alias("full_name"),
        F.length("cc_num").alias("cc_len"),
        X.iso_date(c("dob")).alias("birth_date"),
        X.unix_to_ts(c("unix_time")).cast("timestamp_ntz").alias("unix_ts"),
        X.millis_text(F.unix_millis(at) + 123).alias("millis_text"),
        X.zip_text(c("zip"), pad=True).alias("zip5"),
        X.utf8_length(c("merchant")).alias("merchant_bytes"),
    )


def object_path(spark, sf):
    rows = feed(spark, sf).select("trans_date_trans_time", F.to_json(F.struct("trans_num", "amt")).alias("body"))
    number = X.json_field(F.col("body"), "trans_num")
    at = F.col("trans_date_trans_time")
    return rows.select(
        number.alias("trans_num"),
        X.object_path(number, at).alias("path"),
        X.object_path(number, at, double_slash=True).alias("path_doubled"),
    )


# validation and routing


def _routed(spark, sf):
    return V.validate_and_route(dirty_feed(spark, sf))


def validate_counts(spark, sf):
    return _routed(spark, sf).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def validate_errors(spark, sf):
    errors = V.select_route(_routed(spark, sf), "invalid").select(F.explode("errors").alias("e"))
    return errors.groupBy(F.col("e.loc")[0].alias("field"), F.col("e.type").alias("error"), F.col("e.msg").alias("msg")).agg(
        F.count(F.lit(1)).alias("n")
    )


def route_clean(spark, sf):
    return _naive(V.clean_records(_routed(spark, sf)))


def route_fraud(spark, sf):
    return _naive(V.fraud_records(_routed(spark, sf)))


def route_invalid(spark, sf):
    """Original text, and what the stored record says about its errors."""
    bad = V.attach_errors(V.select_route(_routed(spark, sf), "invalid"))
    kept = F.from_json("payload", "trans_num string, errors array<struct<type string, loc array<string>>>")
    return bad.select("value", kept.alias("p")).select(
        "value",
        F.size("p.errors").alias("n_errors"),
        F.array_join(F.transform("p.errors", lambda e: F.concat(e["loc"][0], F.lit(":"), e["type"])), ",").alias("errors"),
    )


def malformed(spark, sf):
    well, bad = V.split_malformed(V.validate(dirty_feed(spark, sf)))
    return bad.select("value", F.lit(True).alias("malformed"))


def route_store(spark, sf):
    """Every route written in one pass, then read back route by route."""
    root = new_folder(spark, "routed")
    route_sinks(_routed(spark, sf), root, "one", at=datetime(2024, 1, 1, 5, tzinfo=timezone.utc))
    kept = [
        read_route(spark, root, r).select(
            F.lit(r).alias("route"),
            F.get_json_object("value", "$.trans_num").alias("trans_num"),
            F.get_json_object("value", "$.merchant").alias("merchant"),
            F.lit(None).cast("string").alias("text"),
        )
        for r in V.ROUTES
        if r != "malformed"
    ]
    none = F.lit(None).cast("string")
    broken = read_route(spark, root, "malformed").select(
        F.lit("malformed").alias("route"), none.alias("trans_num"), none.alias("merchant"), F.col("value").alias("text")
    )
    return kept[0].union(kept[1]).union(kept[2]).union(broken)


def json_objects(spark, sf):
    """Fraud records stored as JSON under the hour they happened in, read back."""
    root = new_folder(spark, "objects")
    rows = feed(spark, sf).filter("is_fraud")
    write_json_objects(rows, root, F.col("trans_date_trans_time"))
    back = spark.read.schema("trans_num string, amt double, dt string, hh string").json(root)
    return back.select("trans_num", "amt", "dt", "hh")


# messages and frames


def keyed_message(spark, sf):
    rows = feed(spark, sf).withColumn("cc_num", F.when(~F.col("is_fraud"), F.col("cc_num")))
    sent, refused = messages.encode_keyed_message(rows, "cc_num")
    kept = F.from_json("value", "trans_num string, amt double, cc_num string")
    keyed = sent.select("key", kept.alias("v")).select("key", "v.trans_num", "v.amt", F.col("v.cc_num").isNull().alias("key_removed"))
    lost = refused.select(F.lit(None).cast("string").alias("key"), "trans_num", "amt", F.lit(True).alias("key_removed"))
    return keyed.unionByName(lost)


def frame_roundtrip(spark, sf):
    """Every record framed, split by its header and decoded again."""
    rows = as_text_fields(feed(spark, sf))
    framed = frames.encode_frame(messages.encode_message(rows), SCHEMA_ID)
    parts = frames.split_frame(framed)
    decoded = frames.flatten(frames.decode_payload(parts.filter(F.col("well_framed") & (F.col("schema_id") == SCHEMA_ID)), RAW_SCHEMA))
    return decoded.select(*FIELD_NAMES)


def frame_strip(spark, sf):
    """Frames cut without looking at the header; payloads that are not JSON give NULLs."""
    dirty = frames.encode_frame(dirty_feed(spark, sf), SCHEMA_ID)
    return frames.decode_messages(dirty, RAW_SCHEMA).select("trans_num", "cc_num", "merchant", "amt")


#: Registered schemas by id: all fields as text; the amount under an earlier name; no job and no population.
SCHEMAS = {
    SCHEMA_ID: RAW_SCHEMA,
    8: T.StructType([T.StructField("amount" if f.name == "amt" else f.name, f.dataType) for f in RAW_SCHEMA.fields]),
    9: T.StructType([f for f in RAW_SCHEMA.fields if f.name not in ("job", "city_pop")]),
}
DEFAULTS = {"job": "unknown", "city_pop": -1}
ALIASES = {"amt": ["amount"]}


def _frames(rows, number):
    """Records as text fields in frames of the schema ``number`` (a column): 7, 8, 9, or 77, which nobody registered."""
    row = lambda skip, names: F.to_json(F.struct(*[F.col(n).alias(names.get(n, n)) for n in FIELD_NAMES if n not in skip]))
    text = (
        F.when(number == 8, row((), {"amt": "amount"}))
        .when(number == 9, row(("job", "city_pop"), {}))
        .otherwise(row((), {}))
    )
    return frames.encode_frame(rows.select(text.alias("value"), number.alias("number")), F.col("number")).select("value")


def frame_by_schema(spark, sf):
    """Each frame decoded by the schema its header names; frames of unknown ids kept aside."""
    cents = F.round(F.col("amt").cast("double") * 100).cast("bigint")
    number = F.element_at(F.array(*(F.lit(n) for n in (7, 8, 9, 77))), (cents % 4 + 1).cast("int"))
    decoded = frames.decode_by_schema(_frames(as_text_fields(feed(spark, sf)), number), SCHEMAS, RECORD_SCHEMA, DEFAULTS, ALIASES)
    rows = decoded.select("schema_id", "reason", "record.trans_num", "record.amt", "record.job", "record.city_pop", "value")
    lost = F.get_json_object(F.substring("value", 6, 100000).cast("string"), "$.trans_num")
    return rows.withColumn("trans_num", F.coalesce("trans_num", lost)).drop("value")


def message_load(spark, sf):
    """Framed messages as a stream through the whole chain: frame, schema, ids, staging, model; the facts."""
    folder, root = new_folder(spark, "frames"), new_folder(spark, "model")
    configure(spark)
    rows = as_text_fields(feed(spark, sf))
    fraud = F.col("is_fraud") == "1"
    # fraud goes under an unknown id, so it must end aside
    framed = _frames(rows, F.when(fraud, F.lit(77)).when(F.length("merchant") % 2 == 0, F.lit(8)).otherwise(F.lit(SCHEMA_ID)))
    framed.write.option("parquet.block.size", PART_BYTES).parquet(folder)
    stream = message_streams.stream_frames(spark, folder, bytes_per_trigger=BATCH_BYTES)
    wait(message_streams.start_messages(stream, root, new_folder(spark, "check"), SCHEMAS, DEFAULTS, ALIASES, None))
    return _naive(read_table(spark, root, "transactions").select(*TABLES["transactions"].columns))


def _sent(spark, sf):
    configure(spark)
    return table(spark, sf, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("value").alias("latency"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
    )


def delivery_audit(spark, sf):
    return messages.delivery_audit(_sent(spark, sf)).withColumn("avg_latency", F.round("avg_latency", 6))


def stream_audit(spark, sf):
    """The same as a stream: a running aggregate in update mode, its newest states."""
    folder, root = new_folder(spark, "sent"), new_folder(spark, "audit")
    _sent(spark, sf).repartition(4, "partition").write.parquet(folder)
    schema = "topic string, partition int, offset bigint, latency double, timestamp_ms bigint"
    sent = spark.readStream.schema(schema).options(**csv_source.admission(bytes_per_trigger=64 << 10)).parquet(folder)
    wait(message_streams.start_audit(sent, root, new_folder(spark, "check"), None))
    return message_streams.read_audit(spark, root).withColumn("avg_latency", F.round("avg_latency", 6))


def delivery_report(spark, sf):
    return messages.delivery_report(_sent(spark, sf))


# constraints


def _odd_staging(spark, sf):
    """Staging rows some of which break a limit, by their own amount."""
    cents = F.round(F.col("amount") * 100).cast("bigint") % 97
    return staging(spark, sf).withColumns(
        {
            "lat": F.when(cents == 1, F.col("lat") + 500).otherwise(F.col("lat")),
            "long": F.when(cents == 2, F.lit(-180.5)).when(cents == 3, F.lit(None)).otherwise(F.col("long")),
            "job": F.when(cents == 4, F.lit(None)).when(cents == 5, F.repeat("job", 12)).otherwise(F.col("job")),
            "state": F.when(cents == 6, F.concat("state", "state")).otherwise(F.col("state")),
        }
    )


def check_range(spark, sf):
    return C.check_range(_odd_staging(spark, sf)).select("id", "lat", "long")


def check_not_null(spark, sf):
    return C.check_not_null(_odd_staging(spark, sf)).select("id", "job")


def check_length(spark, sf):
    return C.check_length(_odd_staging(spark, sf)).select("id", "job", "state")


def check_all(spark, sf):
    rows = _odd_staging(spark, sf).filter(~C.acceptable())
    return rows.select("id", F.array_join(C.violations(), ",").alias("violated"))


def check_unique(spark, sf):
    lines = table(spark, sf, "lineitem")
    return C.check_unique(lines, ["l_orderkey", "l_linenumber"])


def check_orphans(spark, sf):
    """Facts whose customer was loaded only later."""
    rows = staging_table(spark, sf)
    early = N.load_customer(rows.filter(F.col("transaction_ts") < FIRST_LOAD_ENDS))
    return _naive(C.check_reference(N.load_transactions(rows), "customer_id", early))


# the relational model


def _dimension(name: str):
    def run(spark, sf):
        rows = staging_table(spark, sf)
        rollup = N.seller_rollup(rows) if name in ("category", "merchant", "merchant_category") else N.buyer_rollup(rows)
        return getattr(N, f"load_{name}")(rollup)

    return run


def fact(spark, sf):
    return _naive(N.load_transactions(staging_table(spark, sf)))


def fact_close_pairs(spark, sf):
    """Each record thrice: as it is, half a second later, with a third decimal. All are different facts."""
    at, amount = F.col("trans_date_trans_time"), F.col("amt")
    forms = F.array(
        F.struct(at.alias("at"), amount.alias("amount")),
        F.struct((at + F.expr("interval 500 milliseconds")).alias("at"), amount.alias("amount")),
        F.struct(at.alias("at"), F.round(amount + 0.004, 3).alias("amount")),
    )
    # one pass over the feed; the fact's own columns are stored, since the loader reads them twice
    rows = clean_feed(spark, sf).withColumn("_form", F.explode(forms))
    rows = rows.withColumns({"trans_date_trans_time": F.col("_form.at"), "amt": F.col("_form.amount")}).drop("_form")
    facts = stored(to_staging(rows).select(*TABLES["transactions"].columns.values()), "facts")
    return _naive(N.load_transactions(facts))


def first_city(spark, sf):
    """Same city and state with another population: the first one is kept."""
    rows = staging_table(spark, sf).withColumn("city_pop", F.col("city_pop") + F.year("transaction_ts"))
    return N.load_city(N.buyer_rollup(rows))


def _two_loads(spark, sf):
    rows = staging_table(spark, sf)
    early = F.col("transaction_ts") < FIRST_LOAD_ENDS
    return rows.filter(early), rows.filter(~early)


def _gated(spark, sf, grain):
    first, second = _two_loads(spark, sf)
    return N.load_tables(second, N.load_tables(first), mode="gated", grain=grain)


def gated_customer(spark, sf):
    return _gated(spark, sf, "batch")["customer"]


def gated_fact(spark, sf):
    return _naive(_gated(spark, sf, "batch")["transactions"])


def gated_fact_row(spark, sf):
    return _naive(_gated(spark, sf, "row")["transactions"])


def insert_ignore_two_loads(spark, sf):
    """Both loads' merchants and bridges: what each one adds, appended."""
    first, second = _two_loads(spark, sf)
    stored = N.load_merchant_category(N.seller_rollup(first))
    added = N.load_merchant_category(N.seller_rollup(second), {"merchant_category": stored})
    return append(stored.withColumn("load", F.lit(1)), added.withColumn("load", F.lit(2)))


def insert_ignore_two_keys(spark, sf):
    """An id per order and line, a second key per order, line and part: both must be free."""
    lines = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.concat_ws("-", "l_orderkey", "l_quantity").alias("label"),
        F.col("l_extendedprice").alias("price"),
        F.concat_ws("-", "l_partkey", "l_suppkey").alias("part"),
    )
    return insert_ignore(None, lines, [["id"], ["label"]], ["price", "part"])


def insert_ignore_chain(spark, sf):
    """Chains of 40 rows, each in conflict with the one before it, by one key and the other in turn."""
    place = F.col("c_custkey") % 40
    group = F.floor(F.col("c_custkey") / 40).cast("long") * 100
    rows = table(spark, sf, "customer").select(
        (group + F.floor((place + 1) / 2)).alias("id"), (group + F.floor(place / 2)).alias("label"), "c_custkey"
    )
    return insert_ignore(None, rows, [["id"], ["label"]], ["c_custkey"])


def known_rows(spark, sf):
    """Rows of the second load whose category, merchant and city the first one stored."""
    first, second = _two_loads(spark, sf)
    sellers = N.seller_rollup(first)
    # stored sets: of known size, so a few ids do not bring all rows of one into one task
    rows = known_only(second, "category_id", returning(N.load_category(sellers)))
    rows = known_only(rows, "merchant_id", returning(N.load_merchant(sellers)))
    rows = known_only(rows, "city_id", returning(N.load_city(N.buyer_rollup(first))))
    return rows.select("id", "category_id", "merchant_id", "city_id")


def new_address_rows(spark, sf):
    first, second = _two_loads(spark, sf)
    return not_stored(second, "address_id", N.load_address(N.buyer_rollup(first))).select("id", "address_id")


def denormalised(spark, sf):
    rows = staging_table(spark, sf)
    new = N.load_tables(rows)
    return _naive(denormalise(new)).select(*rows.columns)


def spend_by_category_state(spark, sf):
    """Flagship: load the model, join it back, sum the amounts."""
    wide = denormalise(N.load_tables(staging_table(spark, sf)))
    return wide.groupBy("category", "state").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").try_cast("decimal(28,2)")).cast("double").alias("amount"),
        F.count_distinct("customer_id").alias("customers"),
    )


def orphan_facts(spark, sf):
    """A second load names known customers by other ids: they are refused, and their rows are kept as orphans."""
    root = new_folder(spark, "model")
    rows = staging_table(spark, sf).withColumn("violated", F.lit(None).cast("array<string>"))
    late = F.col("transaction_ts") >= FIRST_LOAD_ENDS
    renamed = rows.filter(late).withColumn("customer_id", F.reverse("customer_id"))
    create_tables(spark, root)
    for load_id, part in (("first", rows.filter(~late)), ("second", renamed)):
        part.write.parquet(f"{root}/staging/load_id={load_id}")
        load_staged(spark, root, load_id)
    return _naive(scan_orphans(spark, root).select("load_id", "id", "transaction_num", "transaction_ts", "customer_id", "amount"))


# profiling and order

_PROFILED = ["street", "city", "state", "zip", "lat", "long", "city_pop", "coord"]


def distinct_counts(spark, sf):
    rows = feed(spark, sf).withColumn("coord", X.comma_pair(F.col("lat"), F.col("long")))
    return profile.distinct_counts(rows, _PROFILED)


def distinct_sketches(spark, sf):
    """Sketches of each year's load, stored and merged: within 5 % (three standard errors) of the exact counts."""
    rows = feed(spark, sf).withColumn("coord", X.comma_pair(F.col("lat"), F.col("long"))).withColumn("year", F.year("trans_date_trans_time"))
    per_load = rows.groupBy("year").agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(profile.LOG_REGISTERS)).alias(c) for c in _PROFILED]
    )
    kept = stored(per_load.unpivot(["year"], _PROFILED, "column_name", "sketch"), "sketches")
    guess = profile.distinct_from_sketches(kept).withColumnRenamed("n_distinct", "guess")
    exact = profile.distinct_counts(rows, _PROFILED)
    near = F.abs(F.col("guess") - F.col("n_distinct")) <= F.ceil(0.05 * F.col("n_distinct"))
    return exact.join(guess, "column_name").select("column_name", "n_distinct", near.alias("within"))


def value_counts(spark, sf):
    return profile.value_counts(feed(spark, sf).withColumn("len", F.length("cc_num")), "category")


def distinct_rows(spark, sf):
    return profile.distinct_rows(feed(spark, sf), ["street", "city", "zip", "lat", "long"])


def duplicated_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return profile.duplicated_rows(lines, ["l_orderkey", "l_linenumber"])


def shape(spark, sf):
    return profile.shape(feed(spark, sf))


def profile_columns(spark, sf):
    rows = feed(spark, sf).withColumn("job", F.when(F.col("gender") == "F", F.col("job")))
    return profile.profile(rows.drop("is_fraud", "trans_date_trans_time"))


def fd_violations(spark, sf):
    return profile.functional_dependency(feed(spark, sf), ["merchant"], "category")


def fd_street_zip(spark, sf):
    return profile.functional_dependency(feed(spark, sf), ["street"], "zip")


def fd_street_card(spark, sf):
    """Streets with several cards: a pair without a dependency."""
    return profile.functional_dependency(feed(spark, sf), ["street"], "cc_num")


_TX = ["amt", "trans_num", "category"]


def top_k(spark, sf):
    return ordering.head(feed(spark, sf).select(*_TX), 20, ["amt", "trans_num"])


def tail_k(spark, sf):
    return ordering.tail(feed(spark, sf).select(*_TX), 5, ["amt", "trans_num"])


def renumber(spark, sf):
    return ordering.renumber(feed(spark, sf).select("category", "trans_num"), ["category"])


# files and streams


def csv_typed(spark, sf):
    """The feed written as CSV files and read against the fixed schema."""
    folder = new_folder(spark, "csv")
    as_text_fields(feed(spark, sf)).select(F.lit("0").alias("_c0"), *FIELD_NAMES).write.option("header", True).csv(folder)
    return _naive(csv_source.read_csv_typed(spark, folder).drop("_c0"))


def csv_strings(spark, sf):
    """The same files read as text and turned into JSON records, then validated."""
    folder = new_folder(spark, "csv")
    rows = as_text_fields(feed(spark, sf)).select(F.lit("0").alias("_c0"), *FIELD_NAMES)
    rows.write.option("header", True).option("maxRecordsPerFile", FILE_RECORDS).csv(folder, compression="gzip")
    routed = V.validate_and_route(csv_source.read_csv_strings(spark, folder))
    return routed.select("record.trans_num", "record.amt", "route")


def csv_inferred(spark, sf):
    folder = new_folder(spark, "csv")
    as_text_fields(feed(spark, sf)).write.option("header", True).csv(folder)
    rows = csv_source.read_csv_inferred(spark, folder)
    return rows.select("trans_num", "amt", "zip", "city_pop", "first")


def stream_load(spark, sf):
    """Raw records as a stream of files: validated, routed, normalised; the facts."""
    folder, root = new_folder(spark, "raw"), new_folder(spark, "model")
    raw_feed(spark, sf).write.option("maxRecordsPerFile", FILE_RECORDS).text(folder, compression="gzip")
    raw = csv_source.stream_records(spark, folder, bytes_per_trigger=BATCH_BYTES)
    wait(start_ingest(raw, root, new_folder(spark, "check"), None))
    return _naive(read_table(spark, root, "transactions").select(*TABLES["transactions"].columns))


def stream_replay(spark, sf):
    """Everything streamed again from a new checkpoint adds nothing."""
    configure(spark)
    folder = new_folder(spark, "csv")
    clean = as_text_fields(clean_feed(spark, sf)).select(F.lit("0").alias("_c0"), *FIELD_NAMES)
    clean.write.option("header", True).option("maxRecordsPerFile", FILE_RECORDS).csv(folder, compression="gzip")
    root = new_folder(spark, "model")
    for _ in range(2):
        records = csv_source.stream_csv_typed(spark, folder, bytes_per_trigger=BATCH_BYTES).drop("_c0")
        wait(start_load(records, root, new_folder(spark, "check"), None))
    return _naive(read_table(spark, root, "transactions").select(*TABLES["transactions"].columns))


def stream_first_seen(spark, sf):
    """Three loads with late and repeated rows, the stream restarted for each: first-seen rows within a watermark.

    A tenth of the first load's rows comes with the second; those older than 30
    days by then are late. Both later loads repeat rows of the one before.
    """
    rows = stored(staging(spark, sf).select("id", "transaction_ts", "amount"), "rows")
    at, held = F.col("transaction_ts"), F.round(F.col("amount") * 100).cast("bigint") % 10 == 0
    one, two = F.lit(FIRST_LOAD_ENDS).cast("timestamp"), F.lit(SECOND_LOAD_ENDS).cast("timestamp")
    days = lambda n: F.expr(f"interval {n} days")
    first = rows.filter((at < one) & ~held)
    second = rows.filter((at >= one) & (at < two))
    repeats = first.filter(at >= one - days(20))
    loads = [
        first,
        second.unionByName(second.filter(held)).unionByName(repeats).unionByName(rows.filter((at < one) & held)),
        rows.filter(at >= two).unionByName(second.filter(at >= two - days(60))),
    ]
    folder, root, check = (new_folder(spark, n) for n in ("in", "seen", "check"))
    for load in loads:
        load.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        wait(start_first_seen(stream, root, check, ["id"], "transaction_ts", "30 days", None, count_rows=False))
    return _naive(spark.read.schema(rows.schema).parquet(root).select(*rows.columns))


def batch_tables(spark, sf):
    """One batch through the stored model; the ids of every table."""
    root = new_folder(spark, "model")
    load_batch(clean_feed(spark, sf), root, "only")
    ids = [scan_ids(read_table(spark, root, name)).select(F.lit(name).alias("table_name"), "id") for name in TABLES]
    out = ids[0]
    for c in ids[1:]:
        out = out.union(c)
    return out


def compacted_model(spark, sf):
    """Two loads, each folded into a segment, the segments merged, one load repeated after that: the facts."""
    root = new_folder(spark, "model")
    rows = stored(clean_feed(spark, sf), "records")
    early = F.col("trans_date_trans_time") < FIRST_LOAD_ENDS
    for load_id, part in (("first", rows.filter(early)), ("second", rows.filter(~early))):
        load_batch(part, root, load_id)
        compact(spark, root, fan=2)
    load_batch(rows.filter(~early), root, "second")
    return _naive(read_table(spark, root, "transactions").select(*TABLES["transactions"].columns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "spend_by_category_state": spend_by_category_state,
    "ids_all": ids_all,
    "ids_sql": ids_sql,
    "ids_separated": ids_separated,
    "staging": staging_rows,
    "used_and_left": used_and_left,
    "scalar_texts": scalar_texts,
    "object_path": object_path,
    "validate_counts": validate_counts,
    "validate_errors": validate_errors,
    "route_clean": route_clean,
    "route_fraud": route_fraud,
    "route_invalid": route_invalid,
    "malformed": malformed,
    "route_store": route_store,
    "json_objects": json_objects,
    "keyed_message": keyed_message,
    "frame_roundtrip": frame_roundtrip,
    "frame_strip": frame_strip,
    "frame_by_schema": frame_by_schema,
    "message_load": message_load,
    "delivery_audit": delivery_audit,
    "stream_audit": stream_audit,
    "delivery_report": delivery_report,
    "check_range": check_range,
    "check_not_null": check_not_null,
    "check_length": check_length,
    "check_all": check_all,
    "check_unique": check_unique,
    "check_orphans": check_orphans,
    "dim_category": _dimension("category"),
    "dim_merchant": _dimension("merchant"),
    "dim_city": _dimension("city"),
    "dim_bridge": _dimension("merchant_category"),
    "dim_address": _dimension("address"),
    "dim_customer": _dimension("customer"),
    "fact": fact,
    "fact_close_pairs": fact_close_pairs,
    "first_city": first_city,
    "gated_customer": gated_customer,
    "gated_fact": gated_fact,
    "gated_fact_row": gated_fact_row,
    "insert_ignore_two_loads": insert_ignore_two_loads,
    "insert_ignore_two_keys": insert_ignore_two_keys,
    "insert_ignore_chain": insert_ignore_chain,
    "known_rows": known_rows,
    "new_address_rows": new_address_rows,
    "denormalised": denormalised,
    "orphan_facts": orphan_facts,
    "distinct_counts": distinct_counts,
    "distinct_sketches": distinct_sketches,
    "value_counts": value_counts,
    "distinct_rows": distinct_rows,
    "duplicated_rows": duplicated_rows,
    "shape": shape,
    "profile": profile_columns,
    "fd_violations": fd_violations,
    "fd_street_zip": fd_street_zip,
    "fd_street_card": fd_street_card,
    "top_k": top_k,
    "tail_k": tail_k,
    "renumber": renumber,
    "csv_typed": csv_typed,
    "csv_strings": csv_strings,
    "csv_inferred": csv_inferred,
    "stream_load": stream_load,
    "stream_replay": stream_replay,
    "stream_first_seen": stream_first_seen,
    "batch_tables": batch_tables,
    "compacted_model": compacted_model,
}
