"""Compares a registered query with its SQL twin: columns, types and all values.

Run as a script to see every query at one scale:
``python tests/compare.py /root/testdata/sf0.01 [name ...]``
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hotdesk")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def twin(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def differences(rows: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty when both agree."""
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    ours = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in rows.schema}
    found = []
    if ours != theirs:
        found.append(f"schema: {sorted(ours.items() ^ theirs.items())}")
        if ours.keys() != theirs.keys():
            return found
    names = sorted(ours)
    left = Counter(tuple(r[n] for n in names) for r in rows.collect())
    order = [relation.columns.index(n) for n in names]
    right = Counter(tuple(r[i] for i in order) for r in relation.fetchall())
    if left.total() != right.total():
        found.append(f"rows: {left.total()} against {right.total()}")
    if left != right:
        extra, missing = left - right, right - left
        found.append(f"values: {extra.total()} rows differ, e.g. {names}")
        found += [f"  ours   {row}" for row in sorted(extra, key=str)[:2]]
        found += [f"  theirs {row}" for row in sorted(missing, key=str)[:2]]
    return found


def main() -> None:
    import __spark_entry__ as registered

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, connection = session(), twin(sf_dir)
    oracle = registered.oracle_sql()
    bad, total = 0, time.time()
    for name, query in registered.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            rows = query(spark, sf_dir)
            found = differences(rows, connection, oracle[name]) if name in oracle else []
            if name not in oracle:
                rows.write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - the report goes on
            found = [str(error)[:1500]]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print(f"{bad} differ, {time.time() - total:.0f}s")


if __name__ == "__main__":
    main()
