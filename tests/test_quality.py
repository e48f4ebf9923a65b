"""One seeded violation per kind of check must be reported, and only that one."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hotdesk.operators import quality
from hotdesk.operators.quality import WARN, Check
from hotdesk.schemas import SourceTable

CHECKS = [
    Check("unique", "t", "k"),
    Check("not_null", "t", "k"),
    Check("accepted_values", "t", "v", values=("a", "b")),
    Check("between", "t", "x", WARN, minimum=0.0),
    Check("column_type", "t", "x", WARN, data_type="double"),
    Check("relationships", "t", "v", parent=("p", "v")),
    Check("row_rule", "t", "x", condition="x > 100 AND v = 'a'"),
]
SCHEMA = "k INT, v STRING, x DOUBLE"
GOOD = [(1, "a", 1.0), (2, "b", 101.0), (3, None, None)]


def outcome(spark, rows, schema=SCHEMA) -> dict[str, tuple[int, str]]:
    tables = {
        "t": spark.createDataFrame(rows, schema),
        "p": spark.createDataFrame([("a",), ("b",), ("z",)], "v STRING"),
    }
    return {r["check_id"]: (r["failures"], r["status"]) for r in quality.report(tables, CHECKS).collect()}


def test_good_rows_pass(spark):
    assert set(outcome(spark, GOOD).values()) == {(0, "pass")}


@pytest.mark.parametrize(
    "row, check, status",
    [
        ((1, "a", 1.0), "unique:t.k", "error"),
        ((None, "a", 1.0), "not_null:t.k", "error"),
        ((4, "z", 1.0), "accepted_values:t.v", "error"),
        ((4, "a", -0.5), "between:t.x", "warn"),
        ((4, "a", 100.5), "row_rule:t.x", "error"),
    ],
)
def test_a_bad_row_is_reported(spark, row, check, status):
    got = outcome(spark, [*GOOD, row])
    assert got.pop(check) == (1, status)
    assert set(got.values()) == {(0, "pass")}


def test_orphans_are_counted_per_row(spark):
    got = outcome(spark, [*GOOD, (4, "q", 1.0), (5, "q", 1.0)])
    assert got["relationships:t.v"] == (2, "error") == got["accepted_values:t.v"]


def test_other_type_is_a_warning(spark):
    got = outcome(spark, [(1, "a", 1)], "k INT, v STRING, x INT")
    assert got["column_type:t.x"] == (1, "warn")


def test_circuit_breaker_limit(spark):
    rows = [(i, "a", 1.0) for i in range(95)] + [(None, "z", 1.0)] * 5
    five = quality.circuit_breaker({"t": spark.createDataFrame(rows, SCHEMA)}, CHECKS).first()
    assert (five["checked_rows"], five["failing_rows"], five["failure_rate"], five["publish"]) == (100, 5, 0.05, True)
    rows[0] = (0, None, 200.0)  # NULL takes part in no rule
    rows[1] = (1, "q", 1.0)
    six = quality.circuit_breaker({"t": spark.createDataFrame(rows, SCHEMA)}, CHECKS).first()
    assert (six["failing_rows"], six["publish"]) == (6, False)
    none = quality.circuit_breaker({"t": spark.createDataFrame([], SCHEMA)}, CHECKS).first()
    assert (none["failure_rate"], none["publish"]) == (0.0, True)


def source(name: str) -> SourceTable:
    return SourceTable(name, "k", f"{name}_sk", "updated_at", "k BIGINT, updated_at TIMESTAMP_NTZ")


def test_source_freshness(spark):
    as_of = datetime(2001, 8, 1, 12)
    ages = {
        "fresh": datetime(2001, 8, 1, 0, 0),
        "late": datetime(2001, 7, 31, 23, 59),
        "edge": datetime(2001, 7, 31, 12, 0),
        "stale": datetime(2001, 7, 31, 11, 59),
        "empty": None,
    }
    sources = {name: source(name) for name in ages}
    landed = {n: spark.createDataFrame([(1, t), (2, None)], sources[n].schema) for n, t in ages.items()}
    got = {r["source_name"]: (r["age_hours"], r["status"]) for r in
           quality.source_freshness(landed, sources, as_of).collect()}
    assert got == {
        "fresh": (12, "pass"), "late": (12, "warn"), "edge": (24, "warn"), "stale": (24, "error"),
        "empty": (None, "error"),
    }


def test_volume_anomaly(spark):
    counts = {1: 100, 2: 100, 3: 9, 5: 100, 6: 4}
    rows = [(date(2001, 1, d),) for d, n in counts.items() for _ in range(n)]
    volumes = quality.daily_volume(spark.createDataFrame(rows, "d DATE"), "t", F.col("d"))
    got = {r["day"].day: (r["row_count"], r["is_anomaly"]) for r in quality.volume_anomaly(volumes).collect()}
    assert got == {1: (100, False), 2: (100, False), 3: (9, True), 4: (0, True), 5: (100, False), 6: (4, True)}


def test_contract(spark):
    sources = {"s": source("s")}
    rows = [(None, 1, "x"), (2, 2, "y")]
    landed = {"s": spark.createDataFrame(rows, "k BIGINT, updated_at INT, extra STRING")}
    got = {r["column_name"]: (r["declared_type"], r["delivered_type"], r["null_count"], r["is_kept"])
           for r in quality.contract(landed, sources).collect()}
    assert got == {
        "k": ("bigint", "bigint", 1, False),
        "updated_at": ("timestamp_ntz", "int", 0, False),
        "extra": (None, "string", 0, False),
    }
    missing = quality.contract({"s": landed["s"].select("k")}, sources).where("column_name = 'updated_at'").first()
    assert (missing["delivered_type"], missing["null_count"], missing["is_kept"]) == (None, None, False)


def test_only_what_is_checked_is_stored(spark, sf_dir):
    """Staging is made as it is read, the fact keeps its checked columns, and no row is lost."""
    from hotdesk.plans import checks
    from hotdesk.queries import Layers, StoredLayers

    at = StoredLayers(spark, sf_dir, checks.of_kind("unique"))
    models = at.models()
    assert {"stg_bookings", "stg_users"} <= set(models) and not {"stg_bookings", "stg_users"} & set(at._stored)
    assert at._stored["fact_bookings"].columns == ["booking_dw_sk", "booking_id"]
    assert models["fact_bookings"].count() == Layers(spark, sf_dir).fact().count()
    every = StoredLayers(spark, sf_dir, list(checks.CHECKS)).models()
    for check in checks.CHECKS:
        assert check.column in every[check.table].columns
        assert not check.parent or check.parent[1] in every[check.parent[0]].columns
