"""Generic operators against brute force, with one key that holds a third of the rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hotdesk.operators import incremental
from hotdesk.operators import slots
from hotdesk.operators.accumulate import first_maximum, leader, prior_totals, with_prior_count
from hotdesk.operators.history import as_versions, point_in_time_join, with_next
from hotdesk.operators.lookups import lookup_join

START = datetime(2001, 1, 1)
HOT = 0


def moments(rng: random.Random, count: int, days: int = 20) -> list[datetime]:
    return [START + timedelta(minutes=m) for m in rng.sample(range(days * 1440), count)]


def skewed_history(rng: random.Random) -> list[tuple[int, datetime]]:
    """Distinct (key, time) pairs; the hot key has a third of them."""
    rows = [(HOT, t) for t in moments(rng, 60)]
    for key in range(1, 13):
        rows += [(key, t) for t in moments(rng, 10)]
    return rows


@pytest.fixture(scope="module")
def history(spark):
    rows = skewed_history(random.Random(7))
    return rows, spark.createDataFrame(rows, "k BIGINT, t TIMESTAMP_NTZ")


@pytest.fixture(params=["calendar", "ranges"], autouse=True)
def slot_size(request, monkeypatch):
    """Everything holds with days and hours as slots, and with ranges of rows."""
    if request.param == "ranges":
        monkeypatch.setattr(slots, "LIMIT", 20)
    return request.param


def test_with_next(history):
    rows, frame = history
    want = set()
    for key in {k for k, _ in rows}:
        times = sorted(t for k, t in rows if k == key)
        want |= set(zip([key] * len(times), times, [*times[1:], None]))
    assert {tuple(r) for r in with_next(frame, "k", "t", "n").collect()} == want


def test_versions_are_half_open_and_one_is_current(history):
    rows, frame = history
    versions = as_versions(frame, "k", "t").collect()
    assert len(versions) == len(rows)
    assert sum(v["is_current_version"] for v in versions) == len({k for k, _ in rows})
    assert all((v["valid_to"] == datetime(9999, 12, 31)) == v["is_current_version"] for v in versions)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_point_in_time_join(spark, history, how):
    rows, frame = history
    rng = random.Random(3)
    versions = as_versions(frame.withColumn("v", F.concat_ws("/", "k", "t")), "k", "t")
    versions = versions.where("k <> 5 OR NOT is_current_version")  # key 5 ends
    facts = [(i, rng.choice([HOT, rng.randrange(15)]), t) for i, t in enumerate(moments(rng, 300, 30))]
    facts += [(1000 + i, k, t) for i, (k, t) in enumerate(rows[:20])]  # exactly at a start
    facts += [(2000, None, START), (2001, HOT, None), (2002, None, None)]
    spans = {}
    for v in versions.collect():
        spans.setdefault(v["k"], []).append((v["valid_from"], v["valid_to"], v["v"]))
    want = set()
    for i, key, at in facts:
        found = [v for a, b, v in spans.get(key, []) if at is not None and a <= at < b]
        assert len(found) <= 1
        if found or how == "left":
            want.add((i, found[0] if found else None))
    joined = point_in_time_join(
        spark.createDataFrame(facts, "i INT, k BIGINT, at TIMESTAMP_NTZ"),
        versions, "k", "at", {"v": "then"}, how,
    )
    assert joined.columns == ["i", "k", "at", "then"]
    got = [(r["i"], r["then"]) for r in joined.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_a_wide_history_forms_no_pairs(spark):
    """A thousand versions of one key: the join's steps hold facts and versions, never their product."""
    versions = spark.range(1000).select(
        F.lit(1).alias("k"),
        F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT))").alias("t"),
        F.col("id").alias("v"),
    )
    versions = as_versions(versions, "k", "t")
    facts = spark.range(500).select("id", F.lit(1).alias("k"), F.expr(
        "TIMESTAMP_NTZ '2001-01-01 00:30:00' + make_dt_interval(0, CAST(2 * id AS INT))").alias("at"))
    joined = point_in_time_join(facts, versions, "k", "at", {"v": "v"})
    assert {(r["id"], r["v"]) for r in joined.collect()} == {(i, 2 * i) for i in range(500)}
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "valid_from" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_rows_without_a_key_have_no_next(spark):
    rows = spark.createDataFrame([(None, START), (None, START.replace(hour=5)), (1, None)], "k INT, t TIMESTAMP_NTZ")
    assert {r["n"] for r in with_next(rows, "k", "t", "n").collect()} == {None}


def test_prior_totals_of_rows_without_a_key(spark):
    rows = [(i, None, START.replace(day=1 + i), 1) for i in range(3)] + [(7, None, START.replace(hour=9), 1)]
    frame = spark.createDataFrame(rows, "i INT, k INT, t TIMESTAMP_NTZ, x INT")
    found = prior_totals(frame, "k", "t", ["t", "i"], {"n": F.lit(1)}).collect()
    assert {r["i"]: r["n"] for r in found} == {0: 0, 7: 1, 1: 2, 2: 3}


def test_a_hot_hour_is_computed_once(spark):
    """A third of the rows on one key and one day: hours split it, and the input is shuffled once."""
    rows = spark.range(3000).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id % 1440 AS INT))").alias("t"),
    )
    found = prior_totals(rows, "k", "t", ["t", "i"], {"n": F.lit(1)})
    hot = sorted(found.where("k = 0").collect(), key=lambda r: (r["t"], r["i"]))
    assert [r["n"] for r in hot] == list(range(len(hot)))


def test_prior_totals(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([HOT, rng.randrange(1, 6)]), t, rng.randrange(5)) for i, t in enumerate(moments(rng, 200, 6))]
    rows += [(900 + i, k, t, 1) for i, k, t, _ in rows[:30]]  # ties in time, split by id
    frame = spark.createDataFrame(rows, "i INT, k BIGINT, t TIMESTAMP_NTZ, x INT")
    got = prior_totals(frame, "k", "t", ["t", "i"], {"n": F.lit(1), "s": F.col("x")}).collect()
    want = set()
    for i, k, t, _ in rows:
        earlier = [x for j, kk, tt, x in rows if kk == k and (tt, j) < (t, i)]
        want.add((i, len(earlier), sum(earlier)))
    assert {(r["i"], r["n"], r["s"]) for r in got} == want and len(got) == len(rows)


def test_leaders_of_the_past(spark):
    """The most frequent earlier value, with the lower one on a tie, and never the row's own."""
    rng = random.Random(11)
    rows = [
        (i, rng.choice([HOT, HOT, None, 1]), t, rng.choice("abcde") if rng.random() < 0.9 else None)
        for i, t in enumerate(moments(rng, 250, 3))
    ]
    frame = spark.createDataFrame(rows, "i INT, k BIGINT, t TIMESTAMP_NTZ, v STRING")
    known = with_prior_count(frame, "k", "t", ["t", "i"], "v", "same")
    measures = {f"c{n}": (F.col("i") % 3 == n).cast("int") for n in range(3)}
    found = prior_totals(known, "k", "t", ["t", "i"], measures, {"led": leader(F.col("same"), F.col("v"))})
    found = found.withColumn("class", first_maximum([F.col(f"c{n}") for n in range(3)]))
    got = {r["i"]: (r["same"], r["led"]["_value"] if r["led"] else None, r["class"]) for r in found.collect()}
    for i, k, t, v in rows:
        earlier = [(j, w) for j, kk, tt, w in rows if kk == k and (tt, j) < (t, i)]
        values = [w for _, w in earlier]
        known = [w for w in values if w is not None]
        classes = [sum(j % 3 == n for j, _ in earlier) for n in range(3)]
        assert got[i] == (
            values.count(v),
            min(known, key=lambda w: (-known.count(w), w), default=None),
            classes.index(max(classes)) if earlier else None,
        )


def test_a_hot_moment_is_spread_evenly(spark, monkeypatch):
    """A third of the rows on one key and one hour: no slot has five times the median's rows."""
    monkeypatch.setattr(slots, "LIMIT", 1000)
    rows = spark.range(60_000).select(
        F.col("id").alias("i"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(id % 7 AS DOUBLE))").alias("t"),
    )
    spread = slots.slotted(rows, "k", ["t", "i"], F.date_trunc("hour", "t"))
    sizes = sorted(r["count"] for r in spread.groupBy(slots.SLOT).count().collect())
    assert len(sizes) > 4 and sizes[-1] < 5 * sizes[len(sizes) // 2] and sum(sizes) == 60_000
    found = prior_totals(rows, "k", "t", ["t", "i"], {"n": F.lit(1)}).where("k = 0")
    hot = sorted(found.collect(), key=lambda r: (r["t"], r["i"]))
    assert [r["n"] for r in hot] == list(range(20_000))


def test_latest_per_key_breaks_ties_by_the_other_columns(spark):
    rows = [(1, START, "a"), (1, START, "b"), (1, None, "z"), (2, None, None), (2, None, "q")]
    frame = spark.createDataFrame(rows, "k INT, t TIMESTAMP_NTZ, v STRING")
    got = incremental.latest_per_key(frame, ["k"], ["t"]).collect()
    assert {tuple(r) for r in got} == {(1, START, "b"), (2, None, "q")}


def test_latest_per_key_limits_groups_before_the_shuffle(spark, sf_dir):
    from hotdesk.queries import QUERIES

    plan = QUERIES["latest_per_key"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_watermark_is_strict(spark):
    frame = spark.createDataFrame([(1, START), (2, START + timedelta(seconds=1)), (3, None)], "i INT, t TIMESTAMP_NTZ")
    got = incremental.newer_than(frame, "t", START).collect()
    assert [r["i"] for r in got] == [2]  # equal and unknown times do not pass
    assert incremental.newer_than(frame, "t", None).count() == 3
    assert incremental.high_watermark(frame, "t") == START + timedelta(seconds=1)
    assert incremental.high_watermark(frame.limit(0), "t") == datetime(1900, 1, 1)


def test_watermark_bound_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = incremental.newer_than(orders, "o_orderdate", datetime(2001, 1, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in text


def test_upsert_replaces_adds_and_syncs_columns(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "old", 6)], "k INT, v STRING, gone INT")
    batch = spark.createDataFrame([(2, "new", True), (3, "new", False)], "k INT, v STRING, fresh BOOLEAN")
    got = incremental.upsert(target, batch, ["k"])
    assert got.columns == ["k", "v", "fresh"]
    assert {tuple(r) for r in got.collect()} == {(1, "old", None), (2, "new", True), (3, "new", False)}


def test_merge_keys_treat_null_as_a_value(spark):
    target = spark.createDataFrame([(None, "old"), (1, "old")], "k INT, v STRING")
    batch = spark.createDataFrame([(None, "new")], "k INT, v STRING")
    got = {tuple(r) for r in incremental.upsert(target, batch, ["k"]).collect()}
    assert got == {(None, "new"), (1, "old")}


def test_lookup_join_keeps_rows_without_a_match(spark):
    rows = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "i INT, k INT")
    lookup = spark.createDataFrame([(10, "ten"), (11, "eleven")], "k INT, name STRING")
    joined = lookup_join(rows, lookup, "k", "k", {"name": "label"})
    assert {tuple(r) for r in joined.collect()} == {(1, 10, "ten"), (2, 99, None), (3, None, None)}
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
