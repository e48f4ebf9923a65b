"""What the plans must look like, and analytics against brute force."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

import pytest

from hotdesk.operators.incremental import newer_than
from hotdesk.plans import analytics, staging
from hotdesk.queries import AS_OF, QUERIES, Layers


def executed(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def at(spark, sf_dir):
    return Layers(spark, sf_dir)


def test_no_python_and_no_unkeyed_window_in_any_lazy_plan(spark, sf_dir):
    for name in ("credit_utilization_l3m", "wide_booking_features", "user_profile_features", "dim_companies",
                 "space_performance_monthly", "scd2_lead", "dq_volume_anomaly", "clean_spaces"):
        plan = executed(QUERIES[name](spark, sf_dir))
        assert "Python" not in plan and "InPandas" not in plan, name
        for line in plan.splitlines():
            if "Window [" in line:
                assert "windowspecdefinition(" in line and "], []" not in line, line


def test_lookups_are_broadcast_by_their_size(at, warehouse):
    """Stored lookups, as a load has them: their files tell Spark that they are small."""
    for name in ("status", "booking_types"):
        warehouse.rebuild(f"clean_{name}", at.clean(name))
    plan = executed(staging.bookings(
        at.clean("bookings"), warehouse.read("clean_status"), warehouse.read("clean_booking_types")))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name, needed", [
    ("credit_utilization_l3m", {"o_orderkey", "o_custkey", "o_orderdate"}),
    ("wide_booking_features", {"o_orderkey", "o_custkey", "o_orderdate"}),
])
def test_products_read_the_bookings_once_without_lookups(spark, sf_dir, name, needed):
    plan = executed(QUERIES[name](spark, sf_dir)).split("== Initial Plan ==")[0]
    assert "status_name" not in plan and "type_name" not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "orders.parquet" in line]
    for line in scans:
        columns = {c.split("#")[0] for c in line.split("FileScan parquet [")[1].split("]")[0].split(",")}
        assert columns <= needed, columns


def test_mart_sums_before_it_joins(at):
    plan = executed(at.mart())
    first_sum = plan.index("partial_sum(credits_used")
    assert plan.index("company_size_tier") < first_sum  # the joins sit above the sum
    # Nothing but the booking's own keys and credits goes into the fact's last shuffle.
    line = next(x for x in plan.splitlines() if "partial_sum(credits_used" in x)
    assert "keys=[company_id" in line and "plan_id" in line and "company_name" not in line


def test_mart_over_stored_tables_scans_the_fact_once(at, warehouse):
    warehouse.rebuild("fact_bookings", at.fact())
    warehouse.rebuild("dim_companies", at.dim("companies"))
    warehouse.rebuild("dim_plans", at.dim("plans"))
    mart = analytics.credit_utilization_l3m(*[warehouse.read(t) for t in (
        "fact_bookings", "dim_companies", "dim_plans")], AS_OF)
    mart.collect()
    plan = executed(mart).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "credits_used" in line]
    assert len(scans) == 1
    columns = scans[0].split("FileScan parquet [")[1].split("]")[0].split(",")
    assert {c.split("#")[0] for c in columns} == {
        "company_id", "plan_id", "credits_used", "check_in_date", "is_cancelled", "is_no_show"}


def test_watermark_reaches_the_scan_behind_a_published_view(at, warehouse):
    warehouse.append("stg_spaces", at.spaces(), "source_updated_at")
    new = newer_than(warehouse.read("stg_spaces"), "source_updated_at", warehouse.loaded_through("stg_spaces"))
    assert "GreaterThan(source_updated_at" in executed(new)


def test_scans_read_only_what_is_asked(spark, sf_dir):
    plan = executed(QUERIES["seats_cdc_latest"](spark, sf_dir))
    scan = plan[plan.index("ReadSchema") :]
    assert "l_extendedprice" not in scan and "l_returnflag" not in scan


def test_mart_against_brute_force(spark, at):
    """The window, the two joins, the sum, the mean and the classes, in plain Python."""
    fact, companies, plans = [
        [r.asDict() for r in rows.collect()] for rows in (at.fact(), at.dim("companies"), at.dim("plans"))
    ]
    company_of = {c["company_id"]: c for c in companies}
    plan_of = {p["plan_id"]: p for p in plans}
    since = date(2001, 5, 1)
    credits = defaultdict(float)
    for b in fact:
        if b["check_in_date"] is None or b["check_in_date"] < since or b["is_cancelled"] or b["is_no_show"]:
            continue
        c, p = company_of[b["company_id"]], plan_of[b["plan_id"]]
        credits[(c["company_id"], c["company_name"], c["company_size_tier"], p["plan_name"], p["plan_type"],
                 p["monthly_credits"], p["cost_per_credit"])] += b["credits_used"]
    rates = {k: round(100 * v / (3 * k[5]), 2) if k[5] else None for k, v in credits.items()}
    known = [r for r in rates.values() if r is not None]
    mean = sum(known) / len(known)
    got = {(r["company_id"], r["plan_name"], r["plan_type"], r["cost_per_credit"], r["teto_creditos_trimestre"]): r
           for r in at.mart().collect()}
    assert len(got) == len(rates) > 10
    for key, rate in rates.items():
        row = got[(key[0], key[3], key[4], key[6], key[5] * 3)]
        assert row["taxa_utilizacao_perc"] == pytest.approx(rate, abs=0.0101)
        assert row["media_geral_rede_perc"] == pytest.approx(mean, abs=0.0101)
        label = "Acima da Média"
        if rate is not None and rate < 30:
            label = "Crítico (Risco Churn)"
        elif rate is not None and rate < mean:
            label = "Abaixo da Média"
        assert row["status_de_engajamento"] == label
    ordered = [r["taxa_utilizacao_perc"] for r in at.mart().collect()]
    filled = [r for r in ordered if r is not None]
    assert filled == sorted(filled) and ordered[len(filled):] == [None] * (len(ordered) - len(filled))


def test_equal_plans_merge_and_idle_companies_are_absent(spark):
    fact = spark.createDataFrame(
        [(1, 1, date(2001, 7, 1), 5.0, False, False), (1, 2, date(2001, 7, 1), 7.0, False, False),
         (2, 1, date(2001, 4, 30), 9.0, False, False), (2, 1, date(2001, 7, 1), 9.0, None, False)],
        "company_id BIGINT, plan_id BIGINT, check_in_date DATE, credits_used DOUBLE, is_cancelled BOOLEAN, is_no_show BOOLEAN",
    )
    companies = spark.createDataFrame([(1, "a", "Small"), (2, "b", "Small")],
                                      "company_id BIGINT, company_name STRING, company_size_tier STRING")
    plans = spark.createDataFrame([(1, "p", "t", 0, None), (2, "p", "t", 0, None)],
                                  "plan_id BIGINT, plan_name STRING, plan_type STRING, monthly_credits INT, cost_per_credit DOUBLE")
    rows = analytics.credit_utilization_l3m(fact, companies, plans, AS_OF).collect()
    assert [(r["company_id"], r["creditos_consumidos_trimestre"], r["taxa_utilizacao_perc"]) for r in rows] == [(1, 12.0, None)]
    assert rows[0]["status_de_engajamento"] == "Acima da Média" and rows[0]["media_geral_rede_perc"] is None
    assert analytics.credit_utilization_l3m(fact, companies, plans).count() == 0  # today is long after
