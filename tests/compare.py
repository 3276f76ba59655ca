"""Run queries in Spark and their SQL in DuckDB over the same files and compare."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            path += "/*.parquet" if os.path.isdir(path) else ""
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs: names, types of Python values, rows. Empty if equal."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    theirs = res.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    mine = _rows(spark_df.columns, spark_df.collect())
    other = _rows(names, theirs)
    if len(mine) != len(other):
        return [f"{len(mine)} rows != {len(other)}"]
    return [f"{a} != {b}" for a, b in zip(mine, other) if repr(a) != repr(b)][:3]


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf, only = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    oracle = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            if name in oracle:
                bad = differences(df, con, oracle[name])
                print(f"{name:28s} {time.time() - start:6.1f}s", "ok" if not bad else f"DIFFERS {bad}", flush=True)
            else:
                print(f"{name:28s} {time.time() - start:6.1f}s rows {df.count()} (no SQL)", flush=True)
        except Exception as exc:  # report and go on with the next query
            print(f"{name:28s} FAILED {type(exc).__name__}: {str(exc)[:600]}", flush=True)
