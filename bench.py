"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3,
the fastest run counts), BENCH_QUERIES (comma-separated names, default the headline list).
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from tidemark.plans.queries import QUERIES

HEADLINE = (
    "scan_merge_schema",
    "stg_transactions",
    "int_users",
    "int_accounts",
    "int_transactions",
    "int_audit",
    "int_transactions_enriched",
    "dim_users",
    "dim_accounts",
    "fct_transactions",
    "fct_audit",
    "high_water_mark",
    "incremental_delta",
    "incremental_upsert",
    "merge_upsert",
    "partitioned_write",
    "raw_load",
    "schema_drift",
    "contract_check",
    "dq_report",
    "quarantine_split",
    "partitioned_upsert",
    "upsert_emptied_days",
    "stream_upsert",
    "fct_transactions_load",
    "evolving_load",
    "row_count_metrics",
    "dq_failures",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, list[float]] = {name: [] for name in names}
    # Round by round, so that no query profits or suffers from its place in the list.
    for _ in range(runs):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - start)
    seconds = {name: round(min(taken), 3) for name, taken in times.items()}
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
