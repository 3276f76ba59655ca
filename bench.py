"""Headline timings over the given tables; prints one JSON line.

Every query is timed once after a small warm-up query, in the order given, and
writes its whole result to a sink that stores nothing.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from txnflow.plans.queries import QUERIES

HEADLINE = [
    "ids_all",
    "staging",
    "validate_counts",
    "route_clean",
    "route_invalid",
    "frame_roundtrip",
    "dim_customer",
    "fact",
    "gated_fact",
    "denormalised",
    "spend_by_category_state",
    "distinct_counts",
    "duplicated_rows",
    "renumber",
    "batch_tables",
    "stream_load",
    "stream_replay",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txnflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        # one load runs more generated classes than the default cache holds
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["shape"](spark, sf_dir).collect()

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "records": lines,
                "records_per_sec": {n: round(lines / s) for n, s in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
