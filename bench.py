"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; its time is the median. Results
go to Spark's ``noop`` sink, so whole results are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from rosterline.plans import all_queries

HEADLINES = [
    "effective_entitlements", "entitlement_summary", "transitive_membership", "transitive_depth",
    "bridge_history", "scd2_feed_history", "scd2_snapshot_apply", "scd2_snapshot_partial_source",
    "assignment_refresh", "snapshot_diff", "history_as_of", "insert_if_no_current",
    "latest_per_key", "percentile_threshold", "iqr_fence", "issue_latency_iqr",
    "issue_report_v1", "issue_report_v2", "population_filter", "dq_uniqueness",
    "dq_validity_overlap", "change_page_flatten", "compact_cluster", "array_column_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    if names == ["all"]:
        names = list(all_queries())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("rosterline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
