"""Feature tables that follow the load: only what a load touches is read and written."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hotdesk import queries
from hotdesk.operators import slots
from hotdesk.plans import feature_store, features

TABLES = {"user_months": "month", "user_places": "month", "space_months": "month", "wide_booking_features": "_part_month"}


@pytest.fixture(scope="module")
def two_loads(spark, sf_dir):
    """The warehouse after both loads, and per refresh its months and the folders it left."""
    at, refreshes = queries.Layers(spark, sf_dir), []
    refresh = feature_store.refresh

    def watched(warehouse, fact, layout):
        months = refresh(warehouse, fact, layout)
        refreshes.append((months, {t: warehouse.partition_folders(t, [c]) for t, c in TABLES.items()}))
        return months

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(feature_store, "refresh", watched)
        warehouse = queries.features_after_two_loads(at)
    return at, warehouse, refreshes


def test_months_before_the_first_change_are_left_alone(two_loads):
    _, warehouse, ((first, before), (second, after)) = two_loads
    cut = date(1999, 1, 1)  # the second load closes versions of that day, bookings come from March on
    assert min(m for m in first if m) < cut and min(m for m in second if m) == cut
    for table in TABLES:
        old = {p: f for p, f in before[table].items() if p[0] and date.fromisoformat(p[0]) < cut}
        assert old and {p: after[table][p] for p in old} == old, table
        assert any(after[table][p] != f for p, f in before[table].items() if p[0] and p not in old), table


def test_a_refresh_reads_only_touched_months(two_loads):
    """The partition filter of a refresh reaches the scan of the fact."""
    _, warehouse, _ = two_loads
    month = F.trunc(F.col("check_in_month"), "month")
    rows = feature_store.user_months(warehouse.read("fact_bookings").where(month.isin([date(2000, 5, 1)])))
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "check_in_month" in filters
    scans = warehouse.read("fact_bookings").where(month.isin([date(2000, 5, 1)])).select(
        F.input_file_name().alias("f")
    ).distinct().collect()
    assert scans and all("check_in_month=2000-05-01" in r["f"] for r in scans)


def test_all_tables_equal_a_full_build(two_loads):
    at, warehouse, _ = two_loads
    full = features.user_behavior_features(at.slim_fact())
    found = warehouse.read("user_behavior_features")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert warehouse.read("dim_date").count() == features.dim_date(at.slim_fact()).count()


def test_a_refresh_without_changes_does_nothing(two_loads):
    _, warehouse, refreshes = two_loads
    assert feature_store.refresh(warehouse, "fact_bookings", ["check_in_month"]) == set()


def past_rows(spark):
    """One busy user, some others and rows without a user, over two days."""
    user = lambda i: 0 if i % 2 else None if i % 10 == 0 else 1 + i % 7
    start = datetime(2001, 1, 1, 5)
    rows = [
        (i, user(i), start + timedelta(minutes=37 * i), "ab"[i % 3 > 0], i % 40, i % 5 == 0) for i in range(80)
    ]
    return spark.createDataFrame(
        rows,
        "booking_id INT, user_id INT, check_in_datetime TIMESTAMP_NTZ, app_type STRING, duration_minutes INT,"
        " is_no_show BOOLEAN",
    )


def test_the_past_takes_one_shuffle(spark):
    """Users that fit a task: windows over user and app, and over the user, by one exchange and no join."""
    plan = features.with_the_past(past_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("limit", [20, 2])
def test_only_busy_users_are_cut(spark, monkeypatch, limit):
    """The same past whether no user, one user (by hours) or every moment is cut."""
    rows = past_rows(spark)
    whole = sorted(map(repr, features.with_the_past(rows).collect()))
    monkeypatch.setattr(slots, "LIMIT", limit)
    assert sorted(map(repr, features.with_the_past(rows).collect())) == whole
    hour = F.date_trunc("hour", "check_in_datetime")
    found = slots.slotted(rows, "user_id", ["check_in_datetime"], hour).where("_slot IS NOT NULL")
    keys = {r["user_id"] for r in found.select("user_id").distinct().collect()}
    assert keys == {0} if limit == 20 else 0 in keys
