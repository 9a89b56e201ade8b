"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Every query runs
once to warm up and ``BENCH_RUNS`` times for the record (best run); the result goes to
the ``noop`` sink, so all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "csv_scan_typed",
    "json_explode",
    "calendar_parts",
    "null_drop_all",
    "distinct_pairs",
    "check_unique_key",
    "insert_new_composite",
    "upsert_single",
    "upsert_one_pass",
    "upsert_composite",
    "upsert_deduped",
    "surrogate_key",
    "layout_sorted",
    "publish_roundtrip",
    "job_movies",
    "job_genre",
    "job_movie_genre",
    "job_date",
    "job_ratings",
    "job_budget",
    "job_load_all",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        best = float("inf")
        for i in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            if i:
                best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": Path(sf).name,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
