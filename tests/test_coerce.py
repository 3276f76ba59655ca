"""The typed reading of single members: fixed pairs, and an independent model where it is installed."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txnflow.operators.validate import validate_and_route
from txnflow.schema import FIELD_NAMES, RECORD_FIELDS

GOOD = {
    "trans_date_trans_time": "2019-01-01 00:00:18",
    "cc_num": "4000111122223333",
    "merchant": "fraud_Alder, Birch and Co",
    "category": "travel",
    "amt": "12.35",
    "first": "Ada",
    "last": "Quill",
    "gender": "F",
    "street": "7 Harbour Row",
    "city": "Eastmoor",
    "state": "ZZ",
    "zip": "10203",
    "lat": "51.25",
    "long": "-3.5",
    "city_pop": "4200",
    "job": "Surveyor, marine",
    "dob": "1990-02-11",
    "trans_num": "t-0001",
    "unix_time": "1546300818",
    "merch_lat": "51.5",
    "merch_long": "-3.25",
    "is_fraud": "0",
}

# JSON texts of one member, per field that stands for its kind
CASES = {
    "is_fraud": ['"0"', '"1"', '"On"', '"off"', '" 1"', '""', '"2"', "2", "1", "1.0", "2.5", "0.5", "null", "[1]", "{}", '"TRUE"', '"y"', "true", "false"],
    "zip": ['"5"', '"5.0"', '" 5 "', '"-7"', '"+7"', '"1_000"', '"1__0"', '"_1"', '"1_"', '"5.5"', '"1e3"', '""', '"5."', '"05"', '"5.00"', "5", "5.0", "5.5", "true", "null", "[1]", "1e3", '"-0"', '"\\t5"', '"1_000.0"', '"x"'],
    "amt": ['"4.97"', '"1e3"', '" 1 "', '"nan"', '"inf"', '"Infinity"', '"-inf"', '"1d"', '"1_000.5"', '"1."', '".5"', '"abc"', '""', "true", "null", "[1]", "5", '"0x1p3"', '"1e400"', '"1E+3"', '"1__0"', '"+-1"'],
    "trans_date_trans_time": ['"2019-01-01 00:00:18"', '"2019-01-01T00:00:18Z"', '"2019-01-01"', '"1325376018"', '"1546300818000"', '"01/02/2019"', '""', "null", '"2019-02-30"', '"2019-01-01 00:00"', '"2019-01-01 00"', '"2019-01-01T00:00:18+05:30"', '"2019-01-01T00:00:18+0530"', '"2019-01-01t00:00:18"', '"2019-01-01_00:00:18"', '" 2019-01-01 00:00:18 "', '"2019-1-1"', "1325376018", "1325376018.5", "true", "[1]", '"2019-01-01 24:00:00"', '"1325376018.5"', '"-5"', '"20000000000"', '"20000000001"', '"2019"', '"1e9"', '"2019-01-01T00:00:18,5"', '"2019-01-01T00:00:18.123456"'],
    "city": ['"x"', '""', '"a \\" : 5"', '"{\\"a\\":1}"', "5", "null", "true", "[1]", '{"a": 1}'],
}


def record(**members):
    """A record as JSON text; a member given as None is left out."""
    texts = {k: json.dumps(v) for k, v in GOOD.items()}
    texts.update(members)
    return "{" + ", ".join(f"{json.dumps(k)}: {v}" for k, v in texts.items() if v is not None) + "}"


def routed(spark, values):
    return validate_and_route(spark.createDataFrame([(v,) for v in values], "value string"))


@pytest.fixture(scope="module")
def outcomes(spark):
    """(field, member text) -> (value, error type)"""
    keys = [(f, m) for f, members in CASES.items() for m in members]
    rows = [(f, m, record(**{f: m})) for f, m in keys]
    df = validate_and_route(spark.createDataFrame(rows, "field string, member string, value string"))
    out = {}
    for r in df.collect():
        errors = [(e["type"], e["loc"], e["input"], e["msg"]) for e in r["errors"]]
        out[r["field"], r["member"]] = (r["record"][r["field"]], errors, r["route"])
    assert set(out) == set(keys)
    return out


def test_same_as_an_independent_model(outcomes):
    pydantic = pytest.importorskip("pydantic")
    types = {"datetime": datetime, "string": str, "float": float, "int": int, "bool": bool}
    model = pydantic.create_model("Record", **{n: (types[k], ...) for n, k in RECORD_FIELDS})
    for (field, member), (value, errors, route) in outcomes.items():
        try:
            expected = getattr(model.model_validate_json(record(**{field: member})), field)
        except pydantic.ValidationError as exc:
            theirs = [(e["type"], [str(x) for x in e["loc"]]) for e in exc.errors()]
            assert [(t, loc) for t, loc, _, _ in errors] == theirs, (field, member)
            assert route == "invalid"
            if not theirs[0][0].startswith("datetime"):
                assert errors[0][3] == exc.errors()[0]["msg"]
            continue
        assert errors == [], (field, member)
        if isinstance(expected, datetime) and expected.tzinfo is not None:
            expected = datetime.fromtimestamp(expected.timestamp())
        assert repr(value) == repr(expected), (field, member)


@pytest.mark.parametrize(
    "field, member, value, error",
    [
        ("is_fraud", '"On"', True, None),
        ("is_fraud", '"2"', None, "bool_parsing"),
        ("is_fraud", "2.5", None, "bool_type"),
        ("zip", '"1_000"', 1000, None),
        ("zip", '"5.5"', None, "int_parsing"),
        ("zip", "5.5", None, "int_from_float"),
        ("amt", '"1d"', None, "float_parsing"),
        ("amt", "null", None, "float_type"),
        ("trans_date_trans_time", '"1546300818000"', datetime(2019, 1, 1, 0, 0, 18), None),
        ("trans_date_trans_time", '"01/02/2019"', None, "datetime_from_date_parsing"),
        ("city", "5", None, "string_type"),
        ("city", '""', "", None),
    ],
)
def test_fixed_pairs(outcomes, field, member, value, error):
    got, errors, _ = outcomes[field, member]
    assert got == value
    assert [e[0] for e in errors] == ([error] if error else [])


def test_integers_beyond_32_bits_are_rejected(spark):
    row = routed(spark, [record(zip='"99999999999"')]).first()
    assert [e["type"] for e in row["errors"]] == ["int_parsing"]


def test_missing_fields_are_all_reported_in_order(spark):
    row = routed(spark, ["{}"]).first()
    assert [e["loc"][0] for e in row["errors"]] == FIELD_NAMES
    assert {e["type"] for e in row["errors"]} == {"missing"}
    assert row["errors"][0]["input"] == "{}"
    assert row["route"] == "invalid"


def test_malformed_texts(spark):
    bad = ['{"a":1', "5", "[1]", '[{"a":1}]', "null", "", '{"a":"x"} trailing', "{'a':1}", None]
    assert {r["route"] for r in routed(spark, bad).collect()} == {"malformed"}


def test_unknown_members_are_ignored_and_the_last_repeat_wins(spark):
    value = record()[:-1] + ', "": "0", "more": [1, 2], "amt": "8"}'
    row = routed(spark, [value]).first()
    assert row["route"] == "clean" and row["record"]["amt"] == 8.0


def test_compact_and_spaced_texts_agree(spark):
    spaced = record(zip="7", lat=None)
    compact = json.dumps(json.loads(spaced), separators=(",", ":"))
    odd = compact.replace('":', '" :\t')
    rows = routed(spark, [spaced, compact, odd]).collect()
    assert len({(str(r["record"]), str([e["type"] for e in r["errors"]])) for r in rows}) == 1
    assert rows[0]["record"]["zip"] == 7


def test_attach_errors_keeps_the_whole_record(spark):
    from txnflow.operators.validate import attach_errors

    value = record(is_fraud='"2"')[:-1] + ', "extra": {"a": [1]}, "errors": "old"}'
    payload = json.loads(attach_errors(routed(spark, [value])).first()["payload"])
    assert payload["extra"] == {"a": [1]}
    assert [(e["type"], e["loc"], e["input"]) for e in payload["errors"]] == [("bool_parsing", ["is_fraud"], "2")]
    assert {k: v for k, v in payload.items() if k in GOOD} == {**GOOD, "is_fraud": "2"}


def test_check_required_marks_absent_members(spark):
    from txnflow.operators.validate import check_required, parse_record

    df = parse_record(spark.createDataFrame([(record(dob=None, job="null"),)], "value string"))
    row = df.select(check_required("dob").alias("a"), check_required("job").alias("b"), check_required("zip").alias("c")).first()
    assert tuple(row) == ("missing", None, None)


def test_validation_is_one_stage_without_python(spark):
    plan = routed(spark, [record()]).filter(F.col("route") == "clean")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    # the barrier keeps the validation out of the filter
    assert plan.index("Filter") < plan.index("Generate") and "from_json" not in plan[: plan.index("Generate")]


def test_two_objects_in_one_text_are_malformed_and_repeated_members_keep_the_last(spark):
    from txnflow.operators.validate import attach_errors

    one = record()
    nested = one[:-1] + ', "more": {"a": {"b": 1}}}'
    twice = one[:-1] + ', "extra": 1, "extra": 2, "zip": "x"}'
    two = [one + one, one + " " + one, one + "," + one, one + "],[" + one, one + ',"z":' + one]
    df = spark.createDataFrame([(t,) for t in [one, nested, twice, *two]], "value string")
    rows = validate_and_route(df).collect()
    assert [r["route"] for r in rows] == ["clean", "clean", "invalid", *["malformed"] * len(two)]
    payload = attach_errors(validate_and_route(df).filter("route = 'invalid'")).first()["payload"]
    assert '"extra":2' in payload and '"extra":1' not in payload and '"errors":[' in payload
