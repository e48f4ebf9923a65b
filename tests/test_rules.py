"""Every branch of the business rules, masks and keys."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hotdesk.functions import business as rules
from hotdesk.functions.keys import surrogate_key
from hotdesk.functions.masking import mask_email, mask_phone

T = datetime(2001, 5, 1, 9, 0)


def values(spark, schema: str, rows: list[tuple], column) -> list:
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"row_no INT, {schema}")
    return [r["v"] for r in frame.select("row_no", column.alias("v")).orderBy("row_no").collect()]


def test_booking_status_priority(spark):
    cases = [
        ((True, True, True, T, T), "cancelled"),
        ((False, True, True, T, T), "no_show"),
        ((False, False, True, T, T), "scheduled"),
        ((False, False, False, T, T), "completed"),
        ((False, False, False, T, None), "checked_in"),
        ((False, False, False, None, None), "unknown"),
        ((False, False, False, None, T), "unknown"),
        ((None, None, None, T, T), "completed"),
        ((None, True, None, None, None), "no_show"),
    ]
    schema = "c BOOLEAN, n BOOLEAN, f BOOLEAN, i TIMESTAMP_NTZ, o TIMESTAMP_NTZ"
    got = values(spark, schema, [c for c, _ in cases], rules.booking_status(*[F.col(x) for x in "cnfio"]))
    assert got == [want for _, want in cases]


@pytest.mark.parametrize(
    "employees, tier",
    [(0, "Small"), (50, "Small"), (51, "Medium"), (200, "Medium"), (201, "Large"), (1000, "Large"),
     (1001, "Enterprise"), (None, "Enterprise")],
)
def test_company_size_tier(spark, employees, tier):
    assert values(spark, "e INT", [(employees,)], rules.company_size_tier(F.col("e"))) == [tier]


def test_duration_is_whole_signed_minutes(spark):
    rows = [
        (T, datetime(2001, 5, 1, 9, 59, 59)),
        (datetime(2001, 5, 1, 9, 59, 59), T),
        (T, None),
        (None, T),
        (datetime(2001, 3, 25, 1, 30), datetime(2001, 3, 25, 3, 30)),
    ]
    got = values(spark, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", rows, rules.duration_minutes(F.col("a"), F.col("b")))
    assert got == [59, -59, None, None, 120]


def test_duration_ignores_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        rows = [(datetime(2001, 3, 25, 1, 30), datetime(2001, 3, 25, 3, 30))]
        got = values(spark, "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", rows, rules.duration_minutes(F.col("a"), F.col("b")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [120]


def test_money_and_rates(spark):
    assert values(spark, "c DOUBLE", [(12345.0,), (0.0,), (None,)], rules.revenue_brl(F.col("c"))) == [123.45, 0.0, None]
    cost = rules.cost_per_credit(F.col("v"), F.col("m"))
    assert values(spark, "v DOUBLE, m INT", [(100.0, 3), (100.0, 0), (100.0, None), (None, 3)], cost) == [
        33.33, None, None, None,
    ]
    rate = rules.occupancy_rate_pct(F.col("t"), F.col("a"))
    assert values(spark, "t INT, a INT", [(3, 1), (0, 0), (None, 1), (4, 4)], rate) == [66.67, 0.0, 0.0, 0.0]
    assert values(spark, "n DOUBLE, d INT", [(1.0, 0), (1.0, 8)], rules.percent(F.col("n"), F.col("d"))) == [None, 12.5]


def test_rounding_scales_first(spark):
    rows = [(1.265,), (45.964999999999996,), (-2.5e-3,), (2.675,)]
    assert values(spark, "x DOUBLE", rows, rules.rounded(F.col("x"))) == [1.26, 45.97, -0.0, 2.68]


def test_engagement_and_churn_limits(spark):
    status = rules.engagement_status(F.col("r"), F.lit(65.5))
    assert values(spark, "r DOUBLE", [(29.99,), (30.0,), (65.49,), (65.5,), (None,)], status) == [
        rules.ENGAGEMENT_CRITICAL, rules.ENGAGEMENT_BELOW, rules.ENGAGEMENT_BELOW,
        rules.ENGAGEMENT_ABOVE, rules.ENGAGEMENT_ABOVE,
    ]
    rows = [(14.99,), (15.0,)]
    assert values(spark, "r DOUBLE", rows, rules.churn_risk_level(F.col("r"))) == ["CRITICAL", "HIGH"]
    assert values(spark, "r DOUBLE", rows, rules.suggested_action(F.col("r"))) == [
        rules.ACTION_URGENT, rules.ACTION_HIGH,
    ]


def test_masks(spark):
    emails = [("maria@site.example",), ("u1@site.example",), ("nobody",), (None,), ("",), ("abc@",)]
    assert values(spark, "e STRING", emails, mask_email(F.col("e"))) == [
        "mar***@site.example", "u1@***@site.example", None, None, None, "abc***@",
    ]
    phones = [("+5511998765432",), ("1234",), ("123",), ("",), (None,)]
    assert values(spark, "p STRING", phones, mask_phone(F.col("p"))) == ["***5432", "***1234", "***", "***", None]


def test_surrogate_key(spark):
    def md5(text: str) -> str:
        return hashlib.md5(text.encode()).hexdigest()

    rows = [(7, T), (7, None)]
    got = values(spark, "i BIGINT, t TIMESTAMP_NTZ", rows, surrogate_key("i", "t"))
    assert got == [md5("7-2001-05-01 09:00:00"), md5("7-_dbt_utils_surrogate_key_null_")]


def test_distance(spark):
    km = rules.distance_km(*[F.col(c) for c in "abcd"])
    rows = [(0.0, 0.0, 0.0, 1.0), (-23.5, -46.6, -23.5, -46.6), (None, 0.0, 0.0, 0.0)]
    assert values(spark, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE", rows, km) == [111.195, 0.0, None]
