"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` the timed runs per query (their median counts, after one warm run).
A run covers building the query and computing every row and column of its result.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from hotdesk.queries import QUERIES

HEADLINE = (
    "credit_utilization_l3m",
    "churn_candidates",
    "clean_bookings",
    "stg_bookings",
    "fact_bookings",
    "dim_spaces",
    "latest_per_key",
    "point_in_time_join",
    "wide_booking_features",
    "user_profile_features",
    "user_behavior_features",
    "space_performance_monthly",
    "dq_report",
    "dq_volume_anomaly",
    "seats_cdc_latest",
    "seats_cdc_stream",
)


def session(cores: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compute(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cores)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            compute(QUERIES[name](spark, sf_dir))
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
