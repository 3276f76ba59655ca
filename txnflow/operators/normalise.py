"""Loading staging rows into the relational model.

Two modes. ``complete`` (default) loads a row whenever its parents are stored
or new. ``gated`` follows the original rule: a customer enters only with an
address that is new in the same statement, and a transaction only if both its
customer and its bridge are. A statement is the whole batch
(``grain="batch"``) or one row (``grain="row"``).

The first write wins. In a batch "first" means the earliest timestamp, then
the smallest values, column by column.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.operators.insert import earliest, first_per_key, in_reach, insert_ignore, returning
from txnflow.operators.joins import gated_by, known_only, not_stored
from txnflow.operators.project import project_entity
from txnflow.schema import ID_COLUMNS, STAGING_COLUMNS, TABLES
from txnflow.session import stored as store
from txnflow.session import together

Stored = Mapping[str, DataFrame]

TS = "transaction_ts"
ROW_ORDER = ["transaction_ts", "transaction_num", "id"]

_SELLER = ["merchant_category_id", "merchant_id", "merchant_name", "category_id", "category"]
_FROM_SELLERS = ["category", "merchant", "merchant_category"]
_FROM_BUYERS = ["city", "address", "customer"]
_BUYER = [
    name
    for name, _ in STAGING_COLUMNS
    if name not in (*_SELLER, "id", TS, "transaction_num", "amount")
]


def seller_rollup(staging: DataFrame) -> DataFrame:
    """Distinct merchant-category combinations with their earliest timestamp.

    The aggregation buffer is one timestamp, so this is a hash aggregate with
    map-side combine; category, merchant and bridge are all taken from it.
    """
    return staging.groupBy(*_SELLER).agg(F.min(TS).alias(TS))


def buyer_rollup(staging: DataFrame) -> DataFrame:
    """The same for customer, address and city."""
    return staging.groupBy(*_BUYER).agg(F.min(TS).alias(TS))


def _key_sets(name: str) -> list[list[str]]:
    """The keys an insert has to check; a UNIQUE key that implies the id needs no check of its own."""
    table = TABLES[name]
    return [["id"]] if table.id_from_unique else [["id"], list(table.unique)]


def _insert(name: str, rows: DataFrame, stored: Stored, order=(TS,), rare_copies: bool = False) -> DataFrame:
    """Insert-or-ignore of one table; ``rows`` has staging columns."""
    table = TABLES[name]
    key_sets = _key_sets(name)
    extra = [c for c in order if c not in table.columns]
    delta = insert_ignore(stored.get(name), project_entity(rows, name, *extra), key_sets, order, rare_copies)
    return delta.select(*table.columns)


def _all_ids(name: str, stored: Stored, delta: DataFrame) -> DataFrame:
    ids = delta.select("id")
    return stored[name].select("id").unionByName(ids) if name in stored else ids


def _with_parents(name: str, rows: DataFrame) -> DataFrame:
    """Rows that name all their parents.

    The parents were loaded from the same rows, and a parent whose id is
    computed from its whole UNIQUE key refuses no id. So being named is being
    stored, and no join is needed. Customers can be refused; see
    ``refused_customers``.
    """
    for fk in TABLES[name].references:
        rows = rows.filter(F.col(TABLES[name].columns[fk]).isNotNull())
    return rows


def load_category(rows: DataFrame, stored: Stored = {}) -> DataFrame:
    return _insert("category", rows, stored)


def load_merchant(rows: DataFrame, stored: Stored = {}) -> DataFrame:
    return _insert("merchant", rows, stored)


def load_city(rows: DataFrame, stored: Stored = {}) -> DataFrame:
    return _insert("city", rows, stored)


def load_merchant_category(rows: DataFrame, stored: Stored = {}) -> DataFrame:
    return _insert("merchant_category", _with_parents("merchant_category", rows), stored)


def load_address(rows: DataFrame, stored: Stored = {}) -> DataFrame:
    return _insert("address", _with_parents("address", rows), stored)


def load_customer(rows: DataFrame, stored: Stored = {}, new_addresses: DataFrame | None = None) -> DataFrame:
    """``new_addresses`` gates the customers; without it all with an address enter."""
    rows = _with_parents("customer", rows)
    if new_addresses is not None:
        rows = gated_by(rows, address_id=new_addresses)
    return _insert("customer", rows, stored)


def refused_customers(buyers: DataFrame, stored: Stored, new_customers: DataFrame) -> DataFrame:
    """Customer ids of the batch that are neither stored nor new: normally none."""
    ids = buyers.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    return not_stored(ids, "customer_id", _all_ids("customer", stored, new_customers))


def load_transactions(
    staging: DataFrame,
    stored: Stored = {},
    refused: DataFrame | None = None,
    new_customers: DataFrame | None = None,
    new_bridges: DataFrame | None = None,
) -> DataFrame:
    """The new facts. Rows of ``refused`` customers stay out; the deltas gate.

    Facts seldom repeat inside a batch, so only the repeated ones are shuffled
    whole. ``staging`` is read twice and should be a stored table.
    """
    rows = _with_parents("transactions", staging)
    if refused is not None:
        rows = rows.join(refused, "customer_id", "left_anti")
    if new_customers is not None and new_bridges is not None:
        rows = gated_by(rows, customer_id=new_customers, merchant_category_id=new_bridges)
    return _insert("transactions", rows, stored, rare_copies=True)


def gate_by_row(staging: DataFrame, stored: Stored = {}) -> tuple[DataFrame, DataFrame]:
    """(customers, transactions) where every row is a statement of its own.

    A customer enters at its first row that is also the first row of a new
    address; a transaction loads if its row is that one and the first row of a
    new bridge. Each "first row" is an aggregate over the staging rows.
    """
    rows = _with_parents("transactions", _with_parents("customer", staging))
    all_cols = rows.columns

    def first_new(df: DataFrame, name: str, key: str) -> DataFrame:
        fresh = not_stored(df, key, stored[name]) if name in stored else df
        return first_per_key(earliest(fresh, key, TS), [key], ROW_ORDER)

    # a row of each address at most; what follows reads it several times
    entry = store(first_new(first_new(rows, "address", "address_id"), "customer", "customer_id"), "entry")
    customers = _insert("customer", entry, stored, tuple(ROW_ORDER[:2]))
    # only bridges that an entry names can let it in
    named = store(entry.select("merchant_category_id").distinct())
    bridge_rows = first_new(rows.join(named, "merchant_category_id", "left_semi"), "merchant_category", "merchant_category_id")
    same_row = ["id", "transaction_ts", "transaction_num", "customer_id", "merchant_category_id", "address_id"]
    facts = entry.join(bridge_rows.select(*same_row), same_row, "left_semi").select(*all_cols)
    return customers, _insert("transactions", known_only(facts, "customer_id", customers), stored)


def load_tables(
    staging: DataFrame, stored: Stored = {}, mode: str = "complete", grain: str = "batch"
) -> dict[str, DataFrame]:
    """The new rows of all seven tables for one batch of staging rows.

    In ``complete`` mode "orphans" holds the staging rows of refused customers,
    whose facts stay out of the model.

    ``staging`` is read four times: once per rollup, for the ids of the facts and
    for the facts. It should be a stored table.
    """
    if mode not in ("complete", "gated") or grain not in ("batch", "row"):
        raise ValueError(f"unknown mode {mode!r} or grain {grain!r}")
    spark = staging.sparkSession
    rollups = (seller_rollup(staging), "sellers"), (buyer_rollup(staging), "buyers")
    sellers, buyers = together(spark, [partial(store, *r) for r in rollups])
    sources = dict.fromkeys(_FROM_SELLERS, sellers) | dict.fromkeys(_FROM_BUYERS, buyers)
    known = [n for n in sources if n in stored]
    near = together(spark, [partial(in_reach, stored[n], project_entity(sources[n], n), _key_sets(n)) for n in known])
    stored = {**stored, **dict(zip(known, near, strict=True))}
    new = {
        "category": load_category(sellers, stored),
        "merchant": load_merchant(sellers, stored),
        "city": load_city(buyers, stored),
        "merchant_category": load_merchant_category(sellers, stored),
        "address": load_address(buyers, stored),
    }
    if mode == "complete":
        new["customer"] = load_customer(buyers, stored)
        refused = store(refused_customers(buyers, stored, new["customer"]))
        none = refused.isEmpty()
        new["transactions"] = load_transactions(staging, stored, refused=None if none else refused)
        new["orphans"] = staging.limit(0) if none else staging.join(refused, "customer_id", "left_semi").select(*staging.columns)
    elif grain == "batch":
        new["customer"] = load_customer(buyers, stored, returning(new["address"]))
        new["transactions"] = load_transactions(
            staging,
            stored,
            new_customers=returning(new["customer"]),
            new_bridges=returning(new["merchant_category"]),
        )
    else:
        new["customer"], new["transactions"] = gate_by_row(staging, stored)
    return new


def with_audit(df: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"created_at": now, "updated_at": now})
