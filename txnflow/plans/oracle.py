"""SQL counterparts of the queries, for an engine with none of this package's code."""

from __future__ import annotations

# Fixed values, written out here: a wrong one in the package must not pass on both sides.
OID_NAMESPACE_HEX = "6ba7b8129dad11d180b400c04fd430c8"
NAME_PREFIX = "something:"
FIRST_LOAD_ENDS = "1995-01-15 00:00:00"
SECOND_LOAD_ENDS = "1997-01-15 00:00:00"
FAULT_CYCLE = 900
TRUE_TEXTS = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXTS = ["0", "off", "f", "false", "n", "no"]
RECORD_FIELDS = [
    ("trans_date_trans_time", "datetime"),
    ("cc_num", "string"),
    ("merchant", "string"),
    ("category", "string"),
    ("amt", "float"),
    ("first", "string"),
    ("last", "string"),
    ("gender", "string"),
    ("street", "string"),
    ("city", "string"),
    ("state", "string"),
    ("zip", "int"),
    ("lat", "float"),
    ("long", "float"),
    ("city_pop", "int"),
    ("job", "string"),
    ("dob", "string"),
    ("trans_num", "string"),
    ("unix_time", "string"),
    ("merch_lat", "float"),
    ("merch_long", "float"),
    ("is_fraud", "bool"),
]
FIELD_NAMES = [name for name, _ in RECORD_FIELDS]
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "bool_type": "Input should be a valid boolean",
    "bool_parsing": "Input should be a valid boolean, unable to interpret input",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "datetime_type": "Input should be a valid datetime",
    "datetime_from_date_parsing": "Input should be a valid datetime or date",
}

FEED = """
feed AS (
  SELECT l_shipdate AS trans_date_trans_time,
         '4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS cc_num,
         'fraud_' || s_name AS merchant,
         p_type AS category,
         l_extendedprice AS amt,
         split_part(c_name, '#', 1) AS first,
         split_part(c_name, '#', 2) AS last,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(c_custkey % 700 AS VARCHAR) || ' Main St' AS street,
         n_name AS city,
         'R' || CAST(n_regionkey AS VARCHAR) AS state,
         CAST((c_custkey % 700) * 137 % 99950 AS INTEGER) AS zip,
         CAST(((c_custkey % 700) * 137 % 99950) % 180 - 90 AS DOUBLE) AS lat,
         CAST(((c_custkey % 700) * 137 % 99950) % 360 - 180 AS DOUBLE) AS long,
         CAST(n_nationkey * 1000 + 100 AS INTEGER) AS city_pop,
         c_mktsegment AS job,
         CAST(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS VARCHAR) AS dob,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS trans_num,
         CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS unix_time,
         CAST(((c_custkey % 700) * 137 % 99950) % 180 - 90 AS DOUBLE) AS merch_lat,
         CAST(((c_custkey % 700) * 137 % 99950) % 360 - 180 AS DOUBLE) AS merch_long,
         l_returnflag = 'R' AND l_quantity > 45 AS is_fraud
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON n_nationkey = (c_custkey % 700) % 25
  JOIN region ON n_regionkey = r_regionkey
)"""

# name: the text hashed into it
_NAMES = {
    "address_id": "street",
    "customer_id": "first || last || dob || cc_num",
    "merchant_id": "merchant",
    "category_id": "category",
    "merchant_category_id": "merchant || category",
    "transaction_id": "trans_num || CAST(CAST(trans_date_trans_time AS TIMESTAMP) AS VARCHAR) || CAST(amt AS VARCHAR)",
}


def uuid(name: str) -> str:
    h = f"sha1(unhex('{OID_NAMESPACE_HEX}') || encode('{NAME_PREFIX}' || ({name})))"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || "
        f"substr({h}, 21, 12)"
    )


def _ids(source: str) -> str:
    cols = ", ".join(f"{uuid(name)} AS {col}" for col, name in _NAMES.items())
    return f"ids AS (SELECT *, city || state AS city_id, {cols} FROM {source})"


_STAGING_SELECT = """
  SELECT transaction_id AS id, trans_date_trans_time AS transaction_ts, trans_num AS transaction_num,
         customer_id, first AS first_name, last AS last_name, gender, job, TRY_CAST(dob AS DATE) AS birth_date,
         cc_num, address_id, street, city_id, city AS city_name, state, city_pop, CAST(zip AS VARCHAR) AS zip,
         lat, long, merchant_category_id, merchant_id, merchant AS merchant_name, category_id, category,
         amt AS amount
  FROM ids"""

STAGING = f"{FEED}, clean AS (SELECT * FROM feed WHERE NOT is_fraud), {_ids('clean')}, staging AS ({_STAGING_SELECT})"


def _first(cols: str, key: str, order: str, source: str = "staging") -> str:
    """First row per key."""
    return (
        f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) "
        "WHERE rn = 1"
    )


_DIMS = {
    "category": ("category_id AS id, category", "category_id", "transaction_ts"),
    "merchant": ("merchant_id AS id, merchant_name", "merchant_id", "transaction_ts"),
    "city": ("city_id AS id, city_name, state, city_pop", "city_id", "transaction_ts, city_pop"),
    "bridge": ("merchant_category_id AS id, merchant_id, category_id", "merchant_category_id", "transaction_ts"),
    "address": (
        "address_id AS id, street, city_id, zip, lat, long",
        "address_id",
        "transaction_ts, street, city_id, zip, lat, long",
    ),
    "customer": (
        "customer_id AS id, first_name, last_name, gender, job, birth_date, cc_num, address_id",
        "customer_id",
        "transaction_ts, gender, job, address_id",
    ),
}
_FACT_COLS = "id, transaction_num, transaction_ts, customer_id, merchant_category_id, amount"
_FACT = _first(_FACT_COLS, "id", "transaction_ts, transaction_num, customer_id, merchant_category_id")

_LOADS = f"""{STAGING},
one AS (SELECT * FROM staging WHERE transaction_ts < TIMESTAMP '{FIRST_LOAD_ENDS}'),
two AS (SELECT * FROM staging WHERE transaction_ts >= TIMESTAMP '{FIRST_LOAD_ENDS}'),
new_bridge AS (SELECT DISTINCT merchant_category_id FROM two
               WHERE merchant_category_id NOT IN (SELECT merchant_category_id FROM one)),
new_address AS (SELECT DISTINCT address_id FROM two WHERE address_id NOT IN (SELECT address_id FROM one)),
entering AS (SELECT * FROM two WHERE address_id IN (SELECT address_id FROM new_address)
             AND customer_id NOT IN (SELECT customer_id FROM one))"""

_TEXTS = {
    "trans_date_trans_time": "strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S')",
    "is_fraud": "CASE WHEN is_fraud THEN '1' ELSE '0' END",
}
_CLOSE_PAIRS = f"""{FEED},
once AS (SELECT * REPLACE (CAST(trans_date_trans_time AS TIMESTAMP) AS trans_date_trans_time) FROM feed WHERE NOT is_fraud),
clean AS (SELECT * FROM once
          UNION ALL SELECT * REPLACE (trans_date_trans_time + INTERVAL 500 MILLISECOND AS trans_date_trans_time) FROM once
          UNION ALL SELECT * REPLACE (round(amt + 0.004, 3) AS amt) FROM once),
{_ids('clean')}, staging AS ({_STAGING_SELECT})"""

_text_cols = ", ".join(f"{_TEXTS.get(n, f'CAST({n} AS VARCHAR)')} AS {n}" for n in FIELD_NAMES)


def _member(i: int, name: str) -> str:
    n = len(FIELD_NAMES)
    return (
        f"CASE WHEN fault = {i} THEN NULL WHEN fault = {n + i} THEN '\"{name}\":\"?\"' "
        f"WHEN fault = {2 * n + i} THEN '\"{name}\":null' WHEN fault = {3 * n + i} THEN '\"{name}\":7.5' "
        f"ELSE '\"{name}\":\"' || {name} || '\"' END"
    )


_n4 = 4 * len(FIELD_NAMES)
_members = ", ".join(_member(i, name) for i, name in enumerate(FIELD_NAMES))
DIRTY = f"""{FEED},
texts AS (SELECT CAST(CAST(round(amt * 100) AS BIGINT) % {FAULT_CYCLE} AS INTEGER) AS fault, {_text_cols} FROM feed),
bodies AS (SELECT fault, '{{' || concat_ws(',', {_members}) || '}}' AS body FROM texts),
dirty AS (SELECT fault, body, CASE WHEN fault = {_n4} THEN array_to_string(string_split(body, ',')[1:5], ',')
                      WHEN fault = {_n4 + 1} THEN '[' || body || ']'
                      WHEN fault = {_n4 + 2} THEN array_to_string(string_split(body, ',')[1:9], ',' || chr(13) || chr(10) || chr(10))
                      WHEN fault = {_n4 + 3} THEN body || ' ' || body
                      WHEN fault = {_n4 + 4} THEN '{{"job":7,' || substr(body, 2)
                      ELSE body END AS value FROM bodies),
marked AS (SELECT fault, value, CASE WHEN fault = {_n4 + 4} THEN body ELSE value END AS parsed,
                  CASE WHEN fault = {_n4 + 3} THEN true
                       WHEN json_valid(value) THEN json_type(value) <> 'OBJECT' ELSE true END AS malformed,
                  CASE WHEN fault = {_n4 + 3} OR fault = {_n4 + 4} THEN body WHEN json_valid(value) THEN value END AS first_object
           FROM dirty)"""

_NUMBERS = "('DOUBLE', 'UBIGINT', 'BIGINT', 'HUGEINT')"
_DATE = r"'\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2})?)?'"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _value(kind: str, t: str, x: str) -> str:
    """The typed value of text ``x`` of JSON type ``t``."""
    if kind == "string":
        return f"CASE WHEN {t} = 'VARCHAR' THEN {x} END"
    if kind == "float":
        return f"CASE WHEN {t} = 'VARCHAR' OR {t} IN {_NUMBERS} THEN TRY_CAST({x} AS DOUBLE) END"
    if kind == "int":
        return (
            f"CASE WHEN {t} = 'VARCHAR' AND regexp_full_match({x}, '[+-]?\\d+') THEN TRY_CAST({x} AS INTEGER) "
            f"WHEN {t} IN {_NUMBERS} AND TRY_CAST({x} AS DOUBLE) = floor(TRY_CAST({x} AS DOUBLE)) "
            f"THEN TRY_CAST({x} AS INTEGER) END"
        )
    if kind == "bool":
        return (
            f"CASE WHEN {t} = 'VARCHAR' THEN CASE WHEN lower({x}) IN {_in(TRUE_TEXTS)} THEN true "
            f"WHEN lower({x}) IN {_in(FALSE_TEXTS)} THEN false END END"
        )
    return (
        f"CASE WHEN {t} = 'VARCHAR' AND regexp_full_match({x}, {_DATE}) THEN TRY_CAST({x} AS TIMESTAMP) "
        f"WHEN {t} IN {_NUMBERS} THEN make_timestamp(CAST(TRY_CAST({x} AS DOUBLE) * 1000000 AS BIGINT)) END"
    )


def _error(name: str, kind: str) -> str:
    t, v = f"t_{name}", f"v_{name}"
    parse = {"string": "string_type", "datetime": "datetime_from_date_parsing"}.get(kind, f"{kind}_parsing")
    number = {"int": "int_from_float", "bool": "bool_type"}.get(kind, parse)
    return (
        f"CASE WHEN {v} IS NOT NULL THEN NULL WHEN {t} IS NULL THEN 'missing' WHEN {t} = 'VARCHAR' THEN '{parse}' "
        f"WHEN {t} IN {_NUMBERS} THEN '{number}' ELSE '{kind}_type' END"
    )


_types = ", ".join(f"json_type(parsed, '$.{n}') AS t_{n}, parsed ->> '$.{n}' AS x_{n}" for n in FIELD_NAMES)
_values = ", ".join(f"{_value(k, f't_{n}', f'x_{n}')} AS v_{n}" for n, k in RECORD_FIELDS)
_errors = ", ".join(f"{_error(n, k)} AS e_{n}" for n, k in RECORD_FIELDS)
_any_error = "coalesce(" + ", ".join(f"e_{n}" for n in FIELD_NAMES) + ")"
ROUTED = f"""{DIRTY},
formed AS (SELECT value, CASE WHEN malformed THEN NULL ELSE parsed END AS parsed FROM marked WHERE NOT malformed),
members AS (SELECT value, {_types} FROM formed),
typed AS (SELECT *, {_values} FROM members),
checked AS (SELECT *, {_errors} FROM typed),
routed AS (SELECT *, CASE WHEN {_any_error} IS NOT NULL THEN 'invalid' WHEN v_is_fraud THEN 'fraud'
                          ELSE 'clean' END AS route FROM checked)"""
_typed_cols = ", ".join(f"v_{n} AS {n}" for n in FIELD_NAMES)
_error_list = "[" + ", ".join(f"'{n}:' || e_{n}" for n in FIELD_NAMES) + "]"
_messages = "CASE error " + " ".join(f"WHEN '{k}' THEN '{m}'" for k, m in MESSAGES.items()) + " END"

_CENTS = "CAST(round(amount * 100) AS BIGINT) % 97"
ODD = f"""{STAGING}, odd AS (SELECT * REPLACE (
  CASE WHEN {_CENTS} = 1 THEN lat + 500 ELSE lat END AS lat,
  CASE WHEN {_CENTS} = 2 THEN -180.5 WHEN {_CENTS} = 3 THEN NULL ELSE long END AS long,
  CASE WHEN {_CENTS} = 4 THEN NULL WHEN {_CENTS} = 5 THEN repeat(job, 12) ELSE job END AS job,
  CASE WHEN {_CENTS} = 6 THEN state || state ELSE state END AS state) FROM staging)"""

_PROFILED = ["street", "city", "state", "zip", "lat", "long", "city_pop", "coord"]
_SPARK_TYPES = {"string": "string", "float": "double", "int": "int"}


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _events(select: str) -> str:
    return f"""WITH sent AS (SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
      value AS latency, epoch_us(ts) // 1000 AS timestamp_ms FROM events) {select}"""


def _rounds(rows: str, order: str, columns: str) -> str:
    """Rows taken in order while both of their keys, id and label, are free: rounds of a recursion."""
    return f"""WITH RECURSIVE src AS ({rows}),
ranked AS (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM src WHERE id IS NOT NULL),
step AS (
  SELECT *, false AS entered FROM ranked
  UNION ALL
  SELECT * EXCLUDE (first, by_id, by_label), first AS entered FROM (
    SELECT *, bool_or(first) OVER (PARTITION BY id) AS by_id, bool_or(first) OVER (PARTITION BY label) AS by_label FROM (
      SELECT * EXCLUDE (entered), n = min(n) OVER (PARTITION BY id) AND n = min(n) OVER (PARTITION BY label) AS first
      FROM step WHERE NOT entered))
  WHERE first OR NOT (by_id OR by_label)
)
SELECT {columns} FROM step WHERE entered"""


_MILLIS = "strftime(make_timestamp({} * 1000), '%Y-%m-%d %H:%M:%S.%f')"

ORACLE: dict[str, str] = {
    "spend_by_category_state": _with(
        STAGING,
        """SELECT category, state, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(12,2))) AS DOUBLE) AS amount,
                  count(DISTINCT customer_id) AS customers FROM staging GROUP BY category, state""",
    ),
    "ids_all": _with(
        f"{FEED}, {_ids('feed')}",
        """SELECT trans_num, city_id, address_id, customer_id, merchant_id, category_id, merchant_category_id,
                  transaction_id FROM ids""",
    ),
    "ids_sql": _with(
        FEED,
        f"""SELECT trans_num, {uuid('first || last || dob || cc_num')} AS customer_id,
                   {uuid('merchant || category')} AS merchant_category_id,
                   {uuid("CASE WHEN is_fraud THEN 'None' ELSE street END")} AS address_or_none FROM feed""",
    ),
    "ids_separated": _with(
        FEED,
        f"""SELECT trans_num, city || chr(31) || state AS city_id,
                   {uuid('first || chr(31) || last || chr(31) || dob || chr(31) || cc_num')} AS customer_id,
                   {uuid('merchant || chr(31) || category')} AS merchant_category_id FROM feed""",
    ),
    "staging": _with(STAGING, "SELECT * FROM staging"),
    "used_and_left": _with(
        FEED,
        """SELECT cc_num, merchant, amt, first, last, gender, street, zip, lat, long, city_pop, job, dob, trans_num,
                  is_fraud FROM feed""",
    ),
    "scalar_texts": _with(
        FEED,
        f"""SELECT trans_num, substr(merchant, 7) AS merchant_name,
                   CAST(lat AS VARCHAR) || ', ' || CAST(long AS VARCHAR) AS coord, first || ', ' || last AS full_name,
                   length(cc_num) AS cc_len, CAST(dob AS DATE) AS birth_date,
                   make_timestamp(CAST(unix_time AS BIGINT) * 1000000) AS unix_ts,
                   {_MILLIS.format('(epoch_us(trans_date_trans_time) // 1000 + 123)')} AS millis_text,
                   lpad(CAST(zip AS VARCHAR), 5, '0') AS zip5, strlen(merchant) AS merchant_bytes FROM feed""",
    ),
    "object_path": _with(
        FEED,
        """SELECT trans_num, '/' || strftime(trans_date_trans_time, '%Y%m%d/%H') || '00/' || trans_num || '.txt' AS path,
                  '/' || strftime(trans_date_trans_time, '%Y%m%d/%H') || '00//' || trans_num || '.txt' AS path_doubled
           FROM feed""",
    ),
    "validate_counts": _with(
        ROUTED,
        """SELECT route, count(*) AS n FROM (SELECT route FROM routed UNION ALL
           SELECT 'malformed' FROM marked WHERE malformed) GROUP BY route""",
    ),
    "validate_errors": _with(
        ROUTED,
        "SELECT field, error, "
        + _messages
        + " AS msg, count(*) AS n FROM ("
        + " UNION ALL ".join(f"SELECT '{n}' AS field, e_{n} AS error FROM routed" for n in FIELD_NAMES)
        + ") WHERE error IS NOT NULL GROUP BY field, error",
    ),
    "route_clean": _with(ROUTED, f"SELECT {_typed_cols} FROM routed WHERE route = 'clean'"),
    "route_fraud": _with(ROUTED, f"SELECT {_typed_cols} FROM routed WHERE route = 'fraud'"),
    "route_invalid": _with(
        ROUTED,
        f"""SELECT value, CAST(len(list_filter(l, lambda x: x IS NOT NULL)) AS INTEGER) AS n_errors,
                   array_to_string(list_filter(l, lambda x: x IS NOT NULL), ',') AS errors
            FROM (SELECT value, {_error_list} AS l FROM routed WHERE route = 'invalid')""",
    ),
    "malformed": _with(DIRTY, "SELECT value, true AS malformed FROM marked WHERE malformed"),
    "route_store": _with(
        ROUTED,
        """SELECT route, x_trans_num AS trans_num, x_merchant AS merchant, NULL AS text FROM routed
           UNION ALL SELECT 'malformed', NULL, NULL, value FROM marked WHERE malformed""",
    ),
    "json_objects": _with(
        FEED,
        """SELECT trans_num, amt, strftime(trans_date_trans_time, '%Y%m%d') AS dt,
                  strftime(trans_date_trans_time, '%H') || '00' AS hh FROM feed WHERE is_fraud""",
    ),
    "keyed_message": _with(
        FEED,
        "SELECT CASE WHEN NOT is_fraud THEN cc_num END AS key, trans_num, amt, true AS key_removed FROM feed",
    ),
    "frame_roundtrip": _with(FEED, f"SELECT {_text_cols} FROM feed"),
    "frame_strip": _with(
        DIRTY,
        """SELECT CASE WHEN json_type(o) = 'OBJECT' THEN o ->> '$.trans_num' END AS trans_num,
                  CASE WHEN json_type(o) = 'OBJECT' THEN o ->> '$.cc_num' END AS cc_num,
                  CASE WHEN json_type(o) = 'OBJECT' THEN o ->> '$.merchant' END AS merchant,
                  CASE WHEN json_type(o) = 'OBJECT' THEN o ->> '$.amt' END AS amt
           FROM (SELECT first_object AS o FROM marked)""",
    ),
    "frame_by_schema": _with(
        f"{FEED}, numbered AS (SELECT *, CAST(round(amt * 100) AS BIGINT) % 4 AS k FROM feed)",
        """SELECT CASE k WHEN 0 THEN 7 WHEN 1 THEN 8 WHEN 2 THEN 9 ELSE 77 END::BIGINT AS schema_id,
                  CASE WHEN k = 3 THEN 'schema' END AS reason, trans_num, CASE WHEN k < 3 THEN amt END AS amt,
                  CASE WHEN k < 2 THEN job WHEN k = 2 THEN 'unknown' END AS job,
                  CASE WHEN k < 2 THEN city_pop WHEN k = 2 THEN -1 END AS city_pop FROM numbered""",
    ),
    "message_load": _with(STAGING, _FACT),
    "stream_audit": _events(
        f"""SELECT topic, "partition", count(*) AS messages, max("offset") AS last_offset,
                   round(avg(latency), 6) AS avg_latency, {_MILLIS.format('max(timestamp_ms)')} AS last_time
            FROM sent GROUP BY topic, "partition" """
    ),
    "delivery_audit": _events(
        f"""SELECT topic, "partition", count(*) AS messages, max("offset") AS last_offset,
                   round(avg(latency), 6) AS avg_latency, {_MILLIS.format('max(timestamp_ms)')} AS last_time
            FROM sent GROUP BY topic, "partition" """
    ),
    "delivery_report": _events(
        f"""SELECT topic, "partition" AS topic_partition, "offset" AS kafka_offset, latency,
                   {_MILLIS.format('timestamp_ms')} AS produce_kafka_time FROM sent"""
    ),
    "check_range": _with(
        ODD,
        "SELECT id, lat, long FROM odd WHERE lat NOT BETWEEN -90 AND 90 OR long NOT BETWEEN -180 AND 180",
    ),
    "check_not_null": _with(ODD, "SELECT id, job FROM odd WHERE job IS NULL"),
    "check_length": _with(ODD, "SELECT id, job, state FROM odd WHERE length(job) > 50 OR length(state) > 2"),
    "check_all": _with(
        ODD,
        """SELECT * FROM (SELECT id, concat_ws(',', CASE WHEN lat NOT BETWEEN -90 AND 90 THEN 'range:lat' END,
             CASE WHEN long NOT BETWEEN -180 AND 180 THEN 'range:long' END, CASE WHEN job IS NULL THEN 'null:job' END,
             CASE WHEN length(job) > 50 THEN 'length:job' END, CASE WHEN length(state) > 2 THEN 'length:state' END)
             AS violated FROM odd) WHERE violated <> ''""",
    ),
    "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "check_orphans": _with(
        _LOADS, f"SELECT {_FACT_COLS} FROM staging WHERE customer_id NOT IN (SELECT customer_id FROM one)"
    ),
    "orphan_facts": _with(
        _LOADS,
        """SELECT 'second' AS load_id, id, transaction_num, transaction_ts, reverse(customer_id) AS customer_id, amount
           FROM two WHERE customer_id IN (SELECT customer_id FROM one)""",
    ),
    **{f"dim_{name}": _with(STAGING, _first(*spec)) for name, spec in _DIMS.items()},
    "fact": _with(STAGING, _FACT),
    "fact_close_pairs": _with(_CLOSE_PAIRS, _FACT),
    "first_city": _with(
        STAGING,
        _first(
            *_DIMS["city"],
            source="(SELECT * REPLACE (CAST(city_pop + year(transaction_ts) AS INTEGER) AS city_pop) FROM staging)",
        ),
    ),
    "gated_customer": _with(_LOADS, _first(*_DIMS["customer"], source="entering")),
    "gated_fact": _with(
        _LOADS,
        f"""SELECT {_FACT_COLS} FROM two WHERE customer_id IN (SELECT customer_id FROM entering)
            AND merchant_category_id IN (SELECT merchant_category_id FROM new_bridge)""",
    ),
    "gated_fact_row": _with(
        f"""{_LOADS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY address_id ORDER BY transaction_ts, transaction_num, id) AS a,
                   row_number() OVER (PARTITION BY merchant_category_id ORDER BY transaction_ts, transaction_num, id) AS b
                   FROM two),
        firsts AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_ts, transaction_num, id) AS c
                   FROM ranked WHERE a = 1 AND address_id IN (SELECT address_id FROM new_address)
                   AND customer_id NOT IN (SELECT customer_id FROM one))""",
        f"""SELECT {_FACT_COLS} FROM firsts WHERE c = 1 AND b = 1
            AND merchant_category_id IN (SELECT merchant_category_id FROM new_bridge)""",
    ),
    "insert_ignore_two_loads": _with(
        _LOADS,
        """SELECT DISTINCT merchant_category_id AS id, merchant_id, category_id, 1 AS load FROM one UNION ALL
           SELECT DISTINCT merchant_category_id, merchant_id, category_id, 2 FROM two
           WHERE merchant_category_id IN (SELECT merchant_category_id FROM new_bridge)""",
    ),
    "insert_ignore_two_keys": _rounds(
        """SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, concat_ws('-', l_orderkey, l_quantity) AS label,
                  l_extendedprice AS price, concat_ws('-', l_partkey, l_suppkey) AS part FROM lineitem""",
        "price, part, id, label",
        "id, label, price, part",
    ),
    "insert_ignore_chain": _rounds(
        """SELECT c_custkey // 40 * 100 + (c_custkey % 40 + 1) // 2 AS id, c_custkey // 40 * 100 + c_custkey % 40 // 2 AS label,
                  c_custkey FROM customer""",
        "c_custkey, id, label",
        "id, label, c_custkey",
    ),
    "known_rows": _with(
        _LOADS,
        """SELECT id, category_id, merchant_id, city_id FROM two WHERE category_id IN (SELECT category_id FROM one)
           AND merchant_id IN (SELECT merchant_id FROM one) AND city_id IN (SELECT city_id FROM one)""",
    ),
    "new_address_rows": _with(
        _LOADS, "SELECT id, address_id FROM two WHERE address_id NOT IN (SELECT address_id FROM one)"
    ),
    "denormalised": _with(STAGING, "SELECT * FROM staging"),
    "distinct_counts": _with(
        f"{FEED}, coords AS (SELECT *, CAST(lat AS VARCHAR) || ', ' || CAST(long AS VARCHAR) AS coord FROM feed)",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM coords" for c in _PROFILED
        ),
    ),
    "distinct_sketches": _with(
        f"{FEED}, coords AS (SELECT *, CAST(lat AS VARCHAR) || ', ' || CAST(long AS VARCHAR) AS coord FROM feed)",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, true AS within FROM coords" for c in _PROFILED
        ),
    ),
    "value_counts": _with(FEED, "SELECT category, count(*) AS n FROM feed GROUP BY category"),
    "distinct_rows": _with(FEED, "SELECT DISTINCT street, city, zip, lat, long FROM feed"),
    "duplicated_rows": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
        SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""",
    "shape": _with(FEED, "SELECT count(*) AS n_rows, 22 AS n_cols FROM feed"),
    "profile": _with(
        FEED,
        " UNION ALL ".join(
            f"SELECT '{n}' AS column_name, count("
            + ("CASE WHEN gender = 'F' THEN job END" if n == "job" else n)
            + f") AS n_filled, '{_SPARK_TYPES[k]}' AS dtype FROM feed"
            for n, k in RECORD_FIELDS
            if k in _SPARK_TYPES
        ),
    ),
    "fd_violations": _with(
        FEED,
        """SELECT merchant, count(DISTINCT category) AS n_values FROM feed GROUP BY merchant
           HAVING count(DISTINCT category) > 1""",
    ),
    "fd_street_zip": _with(
        FEED,
        "SELECT street, count(DISTINCT zip) AS n_values FROM feed GROUP BY street HAVING count(DISTINCT zip) > 1",
    ),
    "fd_street_card": _with(
        FEED,
        "SELECT street, count(DISTINCT cc_num) AS n_values FROM feed GROUP BY street HAVING count(DISTINCT cc_num) > 1",
    ),
    "top_k": _with(FEED, "SELECT amt, trans_num, category FROM feed ORDER BY amt, trans_num LIMIT 20"),
    "tail_k": _with(FEED, "SELECT amt, trans_num, category FROM feed ORDER BY amt DESC, trans_num DESC LIMIT 5"),
    "renumber": _with(
        FEED,
        """SELECT row_number() OVER (ORDER BY category, trans_num) - 1 AS row_no, category, trans_num FROM feed""",
    ),
    "csv_typed": _with(FEED, "SELECT * FROM feed"),
    "csv_strings": _with(
        FEED, "SELECT trans_num, amt, CASE WHEN is_fraud THEN 'fraud' ELSE 'clean' END AS route FROM feed"
    ),
    "csv_inferred": _with(FEED, "SELECT trans_num, amt, zip, city_pop, first FROM feed"),
    "stream_load": _with(STAGING, _FACT),
    "stream_replay": _with(STAGING, _FACT),
    "compacted_model": _with(STAGING, _FACT),
    "stream_first_seen": _with(
        f"""{STAGING},
        sent AS (SELECT id, transaction_ts, amount, transaction_ts < TIMESTAMP '{FIRST_LOAD_ENDS}' AS early,
                        CAST(round(amount * 100) AS BIGINT) % 10 = 0 AS held FROM staging),
        mark AS (SELECT max(transaction_ts) - INTERVAL 30 DAY AS w FROM sent WHERE early AND NOT held)""",
        """SELECT id, transaction_ts, amount FROM sent, mark WHERE NOT early OR NOT held OR transaction_ts > w""",
    ),
    "batch_tables": _with(
        STAGING,
        " UNION ALL ".join(
            f"SELECT DISTINCT '{name}' AS table_name, {col} AS id FROM staging"
            for name, col in [
                ("category", "category_id"),
                ("merchant", "merchant_id"),
                ("city", "city_id"),
                ("merchant_category", "merchant_category_id"),
                ("address", "address_id"),
                ("customer", "customer_id"),
                ("transactions", "id"),
            ]
        ),
    ),
}
