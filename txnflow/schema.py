"""The one schema of a transaction record and of the tables made from it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The fields of a record, in record order, and their kinds.
RECORD_FIELDS: list[tuple[str, str]] = [
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

KIND_TYPES: dict[str, T.DataType] = {
    "datetime": T.TimestampType(),
    "string": T.StringType(),
    # Money and coordinates are 64-bit: 32-bit floats lose cents.
    "float": T.DoubleType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
}

FIELD_NAMES: list[str] = [name for name, _ in RECORD_FIELDS]

RECORD_SCHEMA = T.StructType([T.StructField(name, KIND_TYPES[kind], True) for name, kind in RECORD_FIELDS])
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType(), True) for name in FIELD_NAMES])
CSV_SCHEMA = T.StructType([T.StructField("_c0", T.IntegerType(), True), *RECORD_SCHEMA.fields])

# Staging columns, in table order, and what each is taken from.
STAGING_COLUMNS: list[tuple[str, str]] = [
    ("id", "transaction_id"),
    ("transaction_ts", "trans_date_trans_time"),
    ("transaction_num", "trans_num"),
    ("customer_id", "customer_id"),
    ("first_name", "first"),
    ("last_name", "last"),
    ("gender", "gender"),
    ("job", "job"),
    ("birth_date", "dob"),
    ("cc_num", "cc_num"),
    ("address_id", "address_id"),
    ("street", "street"),
    ("city_id", "city_id"),
    ("city_name", "city"),
    ("state", "state"),
    ("city_pop", "city_pop"),
    ("zip", "zip"),
    ("lat", "lat"),
    ("long", "long"),
    ("merchant_category_id", "merchant_category_id"),
    ("merchant_id", "merchant_id"),
    ("merchant_name", "merchant"),
    ("category_id", "category_id"),
    ("category", "category"),
    ("amount", "amt"),
]


@dataclass(frozen=True)
class Table:
    """One table of the relational model, in terms of staging columns."""

    name: str
    columns: dict[str, str]  # table column -> staging column
    unique: tuple[str, ...]  # the UNIQUE key next to the primary key ``id``
    references: dict[str, str] = field(default_factory=dict)  # column -> parent table
    # True where ``id`` is computed from nothing but the UNIQUE key, so equal
    # UNIQUE keys always have equal ids and the second check can never bind.
    id_from_unique: bool = True


# The relational model, parents before children.
TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table("category", {"id": "category_id", "category": "category"}, ("category",)),
        Table("merchant", {"id": "merchant_id", "merchant_name": "merchant_name"}, ("merchant_name",)),
        Table(
            "city",
            {"id": "city_id", "city_name": "city_name", "state": "state", "city_pop": "city_pop"},
            ("city_name", "state"),
        ),
        Table(
            "merchant_category",
            {"id": "merchant_category_id", "merchant_id": "merchant_id", "category_id": "category_id"},
            ("merchant_id", "category_id"),
            {"merchant_id": "merchant", "category_id": "category"},
        ),
        Table(
            "address",
            {
                "id": "address_id",
                "street": "street",
                "city_id": "city_id",
                "zip": "zip",
                "lat": "lat",
                "long": "long",
            },
            ("street",),
            {"city_id": "city"},
        ),
        Table(
            "customer",
            {
                "id": "customer_id",
                "first_name": "first_name",
                "last_name": "last_name",
                "gender": "gender",
                "job": "job",
                "birth_date": "birth_date",
                "cc_num": "cc_num",
                "address_id": "address_id",
            },
            ("first_name", "last_name", "gender", "job", "birth_date", "cc_num"),
            {"address_id": "address"},
            # the id holds dob as text, the key holds it as a date
            id_from_unique=False,
        ),
        Table(
            "transactions",
            {
                "id": "id",
                "transaction_num": "transaction_num",
                "transaction_ts": "transaction_ts",
                "customer_id": "customer_id",
                "merchant_category_id": "merchant_category_id",
                "amount": "amount",
            },
            ("transaction_num", "transaction_ts", "amount"),
            {"customer_id": "customer", "merchant_category_id": "merchant_category"},
        ),
    ]
}

# Length limits, ranges and required columns of the staging row.
MAX_LENGTHS: dict[str, int] = {
    "first_name": 20,
    "last_name": 20,
    "gender": 1,
    "job": 50,
    "cc_num": 20,
    "state": 2,
    "zip": 5,
}
RANGES: dict[str, tuple[float, float]] = {"lat": (-90.0, 90.0), "long": (-180.0, 180.0)}
REQUIRED: list[str] = [
    "transaction_num",
    "transaction_ts",
    "gender",
    "job",
    "birth_date",
    "cc_num",
    "street",
    "city_name",
    "state",
    "city_pop",
    "zip",
    "merchant_name",
    "category",
    "amount",
]
# Primary keys cannot be null, so a row with a null id can enter no table.
ID_COLUMNS: list[str] = [
    "id",
    "customer_id",
    "address_id",
    "city_id",
    "merchant_category_id",
    "merchant_id",
    "category_id",
]
