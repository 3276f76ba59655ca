import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnflow.functions.ids import joined, register_sql_functions, uuid5_oid


def expected(text):
    return str(uuid.uuid5(uuid.NAMESPACE_OID, f"something:{text}"))


def test_vectors(spark):
    rows = spark.createDataFrame([("a",), ("Zürich",), (None,)], "s string").select(
        uuid5_oid(F.col("s")).alias("id"), uuid5_oid(F.col("s"), null_as_text=True).alias("parity")
    ).collect()
    assert [r["id"] for r in rows] == [
        "8dfdce49-eb87-51a9-89e4-e84227c29a4d",
        "11419283-1680-5453-9d6e-cce183c04cce",
        None,
    ]
    assert rows[2]["parity"] == "cca2968f-861c-5638-b424-47bb976f9b9e"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",))), min_size=50, max_size=200))
def test_same_as_the_standard_library(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string").select("s", uuid5_oid(F.col("s")).alias("id"))
    assert all(r["id"] == expected(r["s"]) for r in df.collect())


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT uuid5_oid('a') a, uuid5_oid(NULL) b, create_deterministic_uuid(concat('x', NULL)) c, "
        "create_deterministic_uuid(concat('x', 'y')) d"
    ).first()
    assert tuple(row) == (expected("a"), None, expected(None), expected("xy"))


def test_separator_keeps_parts_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "x string, y string")
    parts = [F.col("x"), F.col("y")]
    plain = {r[0] for r in df.select(uuid5_oid(joined(parts))).collect()}
    apart = {r[0] for r in df.select(uuid5_oid(joined(parts, "\u001f"))).collect()}
    assert len(plain) == 1 and len(apart) == 2
