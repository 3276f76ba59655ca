"""The record feed derived from the given tables.

The tables hold orders, not card data; one projection over their join gives
every order line the shape of a transaction record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.schema import FIELD_NAMES
from txnflow.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records, one per order line, in record field order.

    The order lines meet part and supplier while they hold keys and numbers
    only, then the orders, which met their customers before. So where a table
    is too large for a broadcast, narrow rows are shuffled, and the wide ones
    never are. Orders and lines grow together, so neither is broadcast. Whether
    a dimension is broadcast is left to Catalyst, which goes by the size of the files.
    """
    configure(spark)
    place = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "n_regionkey")
    )
    street_no = F.col("c_custkey") % 700
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        street_no.alias("street_no"),
        (street_no % 25).cast("int").alias("place_key"),
        "c_name",
        "c_mktsegment",
    )
    buyers = customer.join(place, F.col("place_key") == F.col("n_nationkey"))
    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_shipdate",
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45)).alias("is_fraud"),
    )
    lines = lines.join(
        table(spark, sf_dir, "part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    ).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    zip_code = (F.col("street_no") * 137 % 99950).cast("int")
    shipped = F.col("l_shipdate").cast("timestamp")
    dash = F.lit("-")
    return lines.withColumn("zip", zip_code).select(
        shipped.alias("trans_date_trans_time"),
        F.concat(F.lit("4"), F.lpad(F.col("c_custkey").cast("string"), 15, "0")).alias("cc_num"),
        F.concat(F.lit("fraud_"), "s_name").alias("merchant"),
        F.col("p_type").alias("category"),
        F.col("l_extendedprice").alias("amt"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.col("street_no").cast("string"), F.lit(" Main St")).alias("street"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("state"),
        "zip",
        (F.col("zip") % 180 - 90).cast("double").alias("lat"),
        (F.col("zip") % 360 - 180).cast("double").alias("long"),
        (F.col("n_nationkey") * 1000 + 100).alias("city_pop"),
        F.col("c_mktsegment").alias("job"),
        F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")).cast("string").alias("dob"),
        F.concat(
            F.col("l_orderkey").cast("string"),
            dash,
            F.col("l_linenumber").cast("string"),
            dash,
            F.col("l_partkey").cast("string"),
            dash,
            F.col("l_suppkey").cast("string"),
        ).alias("trans_num"),
        F.unix_seconds(shipped).cast("string").alias("unix_time"),
        (F.col("zip") % 180 - 90).cast("double").alias("merch_lat"),
        (F.col("zip") % 360 - 180).cast("double").alias("merch_long"),
        "is_fraud",
    )


def as_text_fields(records: DataFrame, *keep: str) -> DataFrame:
    """Every field as the text the raw source would carry."""
    texts = {
        "trans_date_trans_time": F.date_format("trans_date_trans_time", "yyyy-MM-dd HH:mm:ss"),
        "is_fraud": F.col("is_fraud").cast("int").cast("string"),
    }
    return records.select(*keep, *[texts.get(n, F.col(n).cast("string")).alias(n) for n in FIELD_NAMES])


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as raw JSON records with text members: one ``value`` column."""
    return as_text_fields(feed(spark, sf_dir)).select(F.to_json(F.struct(*FIELD_NAMES)).alias("value"))


# A record's own amount in cents picks its fault, so the faults are spread over
# the whole feed and are the same in any engine.
FAULT_CYCLE = 900


def dirty_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed in which a tenth of the records is broken by a fixed rule.

    Every record is kept. Fault 0-21 loses field n, 22-43 gives it the text
    "?", 44-65 a JSON null, 66-87 the JSON number 7.5; 88 cuts the text short,
    89 makes it an array, 90 breaks it over several lines and leaves it open,
    91 puts two objects into one text and 92 gives the job twice, the last one right.
    """
    n_fields = len(FIELD_NAMES)
    fault = (F.round(F.col("amt") * 100).cast("bigint") % FAULT_CYCLE).cast("int")
    rows = as_text_fields(feed(spark, sf_dir).withColumn("fault", fault), "fault")
    members = [
        F.when(F.col("fault") == i, F.lit(None).cast("string"))
        .when(F.col("fault") == n_fields + i, f'"{name}":"?"')
        .when(F.col("fault") == 2 * n_fields + i, f'"{name}":null')
        .when(F.col("fault") == 3 * n_fields + i, f'"{name}":7.5')
        .otherwise(F.concat(F.lit(f'"{name}":"'), F.col(name), F.lit('"')))
        for i, name in enumerate(FIELD_NAMES)
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    value = (
        F.when(F.col("fault") == 4 * n_fields, F.substring_index(body, ",", 5))
        .when(F.col("fault") == 4 * n_fields + 1, F.concat(F.lit("["), body, F.lit("]")))
        .when(F.col("fault") == 4 * n_fields + 2, F.replace(F.substring_index(body, ",", 9), F.lit(","), F.lit(",\r\n\n")))
        .when(F.col("fault") == 4 * n_fields + 3, F.concat(body, F.lit(" "), body))
        .when(F.col("fault") == 4 * n_fields + 4, F.concat(F.lit('{"job":7,'), F.substring(body, 2, 100000)))
        .otherwise(body)
    )
    return rows.select(value.alias("value"))
