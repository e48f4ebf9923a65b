"""The whole load: many small loads give what one full load gives, and checks block."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from hotdesk.operators import quality
from hotdesk.plans import daily
from hotdesk.plans.checks import CHECKS
from hotdesk.schemas import SOURCES
from hotdesk.sources.warehouse import Warehouse
from landing_cases import frames, landed_rows, splits

AS_OF = date(2001, 4, 12)
STAR = ["fact_bookings", "dim_companies", "dim_plans", "dim_users", "dim_spaces", daily.MART]
CURRENT = [f"clean_{name}" for name in SOURCES] + STAR


def content(warehouse: Warehouse, table: str) -> set:
    rows = warehouse.read(table)
    names = sorted(rows.columns)
    found = [tuple(r[n] for n in names) for r in rows.collect()]
    assert len(found) == len(set(found)), table
    return set(found)


@pytest.fixture(scope="module")
def make(spark, tmp_path_factory):
    def new() -> Warehouse:
        root = tmp_path_factory.mktemp("daily")
        return Warehouse(spark, str(root), f"daily_{root.name.replace('-', '_')}")

    return new


@pytest.fixture(scope="module", autouse=True)
def few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def loaded(spark, make):
    """One full load, and the rows it was loaded from."""
    rows = landed_rows(random.Random(2))
    warehouse = make()
    daily.run(warehouse, frames(spark, rows), AS_OF)
    return warehouse, rows


def test_loads_in_parts_equal_one_full_load(spark, make, loaded):
    whole, rows = loaded
    stepwise = make()
    for part in splits(rows, 3):
        daily.run(stepwise, frames(spark, part), AS_OF)
    for table in CURRENT:
        assert content(stepwise, table) == content(whole, table), table
    # Every landed version is there, in one load as in several.
    landed = {(r[0], r[-1]) for r in rows["spaces"]}
    versions = whole.read("dim_spaces").select("space_id", "valid_from").collect()
    assert len(versions) == len(landed) == 16 and set(map(tuple, versions)) == landed
    current = stepwise.read("dim_spaces").where("is_current_version")
    assert {r["space_id"]: r["tier"] for r in current.collect()} == {
        r["space_id"]: r["tier"] for r in whole.read("clean_spaces").collect()
    }
    # The same input once more changes nothing.
    before = {t: content(stepwise, t) for t in CURRENT}
    daily.run(stepwise, frames(spark, rows), AS_OF)
    assert {t: content(stepwise, t) for t in CURRENT} == before
    # So does a full refresh.
    daily.run(stepwise, frames(spark, rows), AS_OF, full_refresh=True)
    for table in CURRENT:
        assert content(stepwise, table) == content(whole, table), table


def test_every_declared_check_passes_and_personal_data_is_gone(loaded):
    warehouse, _ = loaded
    for table in ("stg_users", *STAR):
        assert not {"email", "phone"} & set(warehouse.read(table).columns)
    report = quality.report({c.table: warehouse.read(c.table) for c in CHECKS}, CHECKS).collect()
    assert len(report) == 68 and {r["status"] for r in report} == {"pass"}


FEATURES = ["dim_date", "space_performance_monthly", "user_behavior_features", "user_profile_features",
            "wide_booking_features"]


def test_features_are_kept_when_the_breaker_opens(spark, loaded):
    warehouse, _ = loaded
    assert all(r["publish"] for r in daily.refresh_features(warehouse).collect())
    before = {t: content(warehouse, t) for t in FEATURES}
    assert len(before["wide_booking_features"]) > 0
    spaces = warehouse.stage("spaces_now", warehouse.read("dim_spaces"))
    warehouse.rebuild("dim_spaces", spaces.withColumn("space_id", F.lit(None).cast("bigint")))
    report = {r["table_name"]: r["publish"] for r in daily.refresh_features(warehouse).collect()}
    assert report == {"stg_bookings": True, "fact_bookings": True, "dim_spaces": False}
    assert {t: content(warehouse, t) for t in FEATURES} == before
    warehouse.rebuild("dim_spaces", spaces)


def test_churn_export(spark, loaded, tmp_path):
    warehouse, _ = loaded
    mart = warehouse.read(daily.MART)
    low = mart.where("taxa_utilizacao_perc < 1000").count()
    assert low > 0
    readers = {
        "json": spark.read.json,
        "json_array": spark.read.option("multiLine", True).json,
        "csv": spark.read.option("header", True).csv,
    }
    for output, read in readers.items():
        for _ in range(2):  # an export replaces the one before it
            summary = daily.export_churn(warehouse, str(tmp_path / output), 1000.0, output)
            assert sum(r["candidates"] for r in summary.collect()) == low
            assert read(str(tmp_path / output)).count() == low
        assert daily.export_churn(warehouse, str(tmp_path / f"no-{output}"), -1.0, output).count() == 0
        assert not (tmp_path / f"no-{output}").exists()


def test_a_failed_check_blocks_the_table_and_what_follows(spark, loaded):
    warehouse, rows = loaded
    before = {t: content(warehouse, t) for t in ("stg_bookings", *STAR)}
    bad = list(rows["bookings"][0])
    bad[15], bad[16] = True, False  # cancelled, and not a no-show ...
    bad[11] = bad[20]  # ... yet checked in
    bad[20] = bad[20].replace(year=2002)
    landed = {**rows, "bookings": [*rows["bookings"], tuple(bad)]}
    with pytest.raises(daily.ChecksFailed, match="row_rule:stg_bookings.check_in_datetime: 1"):
        daily.run(warehouse, frames(spark, landed), AS_OF)
    assert {t: content(warehouse, t) for t in ("stg_bookings", *STAR)} == before
    daily.run(warehouse, frames(spark, landed), AS_OF, blocking_checks=False)
    assert warehouse.read("stg_bookings").count() == len(before["stg_bookings"]) + 1


def test_undated_bookings_are_merged_by_month(spark, loaded):
    warehouse, rows = loaded
    undated = [r for r in rows["bookings"] if r[11] is None]
    late = list(undated[-1])
    late[0], late[1], late[20] = 900, 20010901, late[20].replace(year=2003)
    late[15] = late[16] = False
    before = {r["file"] for r in warehouse.read("fact_bookings").select(F.input_file_name().alias("file")).collect()}
    daily.run(warehouse, frames(spark, {**rows, "bookings": [*rows["bookings"], tuple(late)]}), AS_OF)
    fact = warehouse.read("fact_bookings").select("date_id", F.input_file_name().alias("file")).collect()
    # Nothing but the one new month was written.
    assert {r["date_id"] for r in fact if r["file"] not in before} == {20010901}
    assert "_part_month" not in warehouse.read("fact_bookings").columns


def test_a_broken_contract_stops_the_load_and_an_empty_day_is_reported(spark, loaded, make):
    warehouse, rows = loaded
    landed = frames(spark, rows)
    broken = {**landed, "plans": landed["plans"].drop("plan_value")}
    fresh = make()
    with pytest.raises(daily.ChecksFailed, match="contract:plans.plan_value"):
        daily.run(fresh, broken, AS_OF)
    assert not fresh.exists("clean_bookings")
    report = {r["source_name"]: r["status"] for r in warehouse.read("source_report").collect()}
    assert report.keys() == SOURCES.keys()
    assert {r["odd_days"] for r in daily.source_report(landed, AS_OF).collect()} == {0}
    gap = landed["bookings"].where("updated_at < TIMESTAMP_NTZ '2001-04-01 12:00:00'").unionByName(
        landed["bookings"].withColumn("updated_at", F.expr("updated_at + INTERVAL '4' DAY"))
    )
    odd = {r["source_name"]: r["odd_days"] for r in daily.source_report({**landed, "bookings": gap}, AS_OF).collect()}
    assert odd["bookings"] > 0


def as_text(landed):
    return {n: rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns]) for n, rows in landed.items()}


def test_bad_values_are_set_aside_and_the_rest_is_loaded(spark, loaded, make):
    """Tables that land as text, with a few bad values, give the tables of the good rows."""
    whole, rows = loaded
    landed, last = as_text(frames(spark, rows)), max(r[0] for r in rows["bookings"])
    one = landed["bookings"].limit(1)
    spoilt = one.withColumns({"booking_id": F.lit(str(last + 1)), "credits": F.lit("many"), "date_id": F.lit("x")})
    nameless = one.withColumn("booking_id", F.lit(None).cast("string"))
    landed["bookings"] = landed["bookings"].unionByName(spoilt).unionByName(nameless)
    fresh = make()
    daily.run(fresh, landed, AS_OF, quarantine=True)
    assert content(fresh, "rejected_values") == {
        ("credits", "no double", str(last + 1), "bookings", "many"),
        ("date_id", "no bigint", str(last + 1), "bookings", "x"),
        ("booking_id", "missing", None, "bookings", None),
    }
    assert fresh.read("clean_plans").schema == whole.read("clean_plans").schema
    assert fresh.read("fact_bookings").count() == len({r[0] for r in rows["bookings"]})


def test_too_many_bad_values_stop_the_load(spark, loaded, make):
    _, rows = loaded
    landed = as_text(frames(spark, rows))
    landed["plans"] = landed["plans"].withColumn("plan_value", F.lit("free"))
    fresh = make()
    with pytest.raises(daily.ChecksFailed, match="rejects:plans"):
        daily.run(fresh, landed, AS_OF, quarantine=True)
    assert not fresh.exists("clean_bookings") and fresh.read("rejected_values").count() == len(rows["plans"])
