"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from rivermark.plans import QUERIES
from rivermark.session import STATIC, configure

HEADLINE = (
    "envelope_kinds",
    "cdc_history",
    "accounts_current",
    "cdc_dedup_accepted",
    "cdc_latest_all",
    "cdc_state_merge",
    "cdc_event_decisions",
    "cdc_batch_summary",
    "refs_unresolved",
    "settle_validate",
    "settle_accepted",
    "settle_file_counts",
    "settle_duplicates",
    "latest_run",
    "ledger_illegal_transitions",
    "refund_running_total",
    "refund_violations",
    "fk_orphans",
    "project_payments",
    "dataset_fingerprint",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in STATIC.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        # The better of two runs: the first one also compiles the plan.
        seconds = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(min(seconds), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
