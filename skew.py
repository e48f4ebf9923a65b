"""Times the steps that must stand a hot key: a third of the rows on one key, against even keys.

``python skew.py [rows]`` prints the seconds of two warm runs each. With ``hot day`` the hot
key's rows lie on one day besides, with ``hot hour`` in one hour.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from bench import compute, session
from hotdesk.operators.accumulate import prior_totals
from hotdesk.operators.history import as_versions, point_in_time_join, with_next
from hotdesk.operators.incremental import latest_per_key

SECOND = "TIMESTAMP_NTZ '2001-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST({} AS DOUBLE))"


def rows_with(spark: SparkSession, count: int, hot: bool, span: int) -> DataFrame:
    key = F.col("id") % 100_000 + 1
    return spark.range(count).select(
        "id",
        (F.when(F.col("id") % 3 == 0, 0).otherwise(key) if hot else key).alias("k"),
        F.expr(SECOND.format(f"id * 7919 % {span}")).alias("t"),
        (F.col("id") % 10).alias("x"),
    )


def steps(rows: DataFrame) -> dict[str, DataFrame]:
    versions = as_versions(rows.where("id % 20 = 0").dropDuplicates(["k", "t"]), "k", "t")
    return {
        "latest version": latest_per_key(rows, ["k"], ["t"]),
        "next version": with_next(rows, "k", "t", "n"),
        "running totals": prior_totals(rows, "k", "t", ["t", "id"], {"s": F.col("x")}),
        "merge by time": point_in_time_join(rows, versions, "k", "t", {"x": "then"}),
    }


def main() -> None:
    count = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = session("8")
    for name, shape in {
        "hot hour": (True, 3600),
        "hot key": (True, 86_400 * 365),
        "hot day": (True, 86_400),
        "even keys": (False, 86_400 * 365),
    }.items():
        for step, rows in steps(rows_with(spark, count, *shape)).items():
            seconds = []
            for _ in range(3):
                start = time.perf_counter()
                compute(rows)
                seconds.append(round(time.perf_counter() - start, 1))
            print(f"{step} | {name} | {seconds[1:]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
