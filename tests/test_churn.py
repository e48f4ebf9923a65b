"""The churn list on five known rows, and its exports."""

from __future__ import annotations

import os

import pytest

from hotdesk.functions import business as rules
from hotdesk.plans import analytics
from hotdesk.sources import files

MART = """company_id BIGINT, company_name STRING, company_size_tier STRING, plan_name STRING, plan_type STRING,
    creditos_consumidos_trimestre DOUBLE, teto_creditos_trimestre INT, cost_per_credit DOUBLE,
    taxa_utilizacao_perc DOUBLE, media_geral_rede_perc DOUBLE, delta_vs_media DOUBLE, status_de_engajamento STRING"""


def mart_row(company: int, rate: float | None, name: str = "Firma São João") -> tuple:
    delta = None if rate is None else round(rate - 65.5, 2)
    return (company, name, "Medium", "plan, \"A\"", "basic", 50.0, 300, 2.5, rate, 65.5, delta, "x")


@pytest.fixture(scope="module")
def mart(spark):
    rates = {101: 90.0, 202: 16.6, 303: 25.0, 404: 93.3, 505: 24.0}
    return spark.createDataFrame([mart_row(c, r) for c, r in rates.items()], MART)


@pytest.mark.parametrize("threshold, ids", [(30.0, {202, 303, 505}), (25.0, {202, 505}), (1.0, set())])
def test_candidates_by_threshold(mart, threshold, ids):
    rows = analytics.churn_candidates(mart, threshold).collect()
    assert {r["company_id"] for r in rows} == ids
    assert {r["churn_risk_level"] for r in rows} <= {"HIGH"}


def test_levels_and_unknown_rates(spark):
    rows = [mart_row(1, 14.99), mart_row(2, 15.0), mart_row(3, None), mart_row(4, 0.0)]
    got = analytics.churn_candidates(spark.createDataFrame(rows, MART)).collect()
    assert {(r["company_id"], r["churn_risk_level"], r["suggested_action"]) for r in got} == {
        (1, "CRITICAL", rules.ACTION_URGENT), (2, "HIGH", rules.ACTION_HIGH), (4, "CRITICAL", rules.ACTION_URGENT),
    }
    summary = {r["churn_risk_level"]: r["candidates"] for r in analytics.churn_summary(
        analytics.churn_candidates(spark.createDataFrame(rows, MART))).collect()}
    assert summary == {"CRITICAL": 2, "HIGH": 1}


def text_of(folder: str) -> str:
    parts = [f for f in sorted(os.listdir(folder)) if f.startswith("part-")]
    return "".join(open(os.path.join(folder, f), encoding="utf-8").read() for f in parts)


def test_exports_round_trip_unescaped(spark, mart, tmp_path):
    rows = [mart_row(1, 14.99, 'say "hi"\\, ok'), mart_row(2, 3.5, ""), mart_row(3, 29.0)]
    candidates = analytics.churn_candidates(spark.createDataFrame(rows, MART))
    want = sorted(map(tuple, candidates.collect()))
    files.export_json(candidates, str(tmp_path / "json"))
    assert "São João" in text_of(str(tmp_path / "json"))
    read = files.read_json_lines(spark, str(tmp_path / "json"), candidates.schema)
    assert sorted(map(tuple, read.collect())) == want
    assert files.export_csv(candidates, str(tmp_path / "csv"))
    assert text_of(str(tmp_path / "csv")).startswith("company_id,company_name,company_size_tier")
    read = files.read_csv(spark, str(tmp_path / "csv"), candidates.schema)
    empty_is_null = sorted((tuple(None if v == "" else v for v in row) for row in want))
    assert sorted(tuple(None if v == "" else v for v in row) for row in map(tuple, read.collect())) == empty_is_null


def test_empty_csv_writes_nothing(mart, tmp_path):
    assert not files.export_csv(analytics.churn_candidates(mart, 1.0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_json_arrays(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS name", "IF(id % 3 = 0, NULL, id / 2) AS half")
    files.write_json_arrays(rows, str(tmp_path / "arrays"), rows_per_file=100)
    texts = [f for f in os.listdir(tmp_path / "arrays") if f.startswith("part-")]
    assert len(texts) >= 10
    first = (tmp_path / "arrays" / texts[0]).read_text()
    assert first.startswith("[{") and first.rstrip().endswith("}]")
    read = files.read_json_array(spark, str(tmp_path / "arrays"), rows.schema)
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))


def test_json_arrays_of_nothing(spark, tmp_path):
    rows = spark.createDataFrame([], "id INT")
    files.write_json_arrays(rows, str(tmp_path / "none"))
    assert files.read_json_array(spark, str(tmp_path / "none"), rows.schema).collect() == []


def test_one_indented_array_is_read_too(spark, tmp_path):
    (tmp_path / "one.json").write_text('[\n  {"id": 1,\n   "name": "São"},\n  {"id": 2}\n]', encoding="utf-8")
    read = files.read_json_array(spark, str(tmp_path / "one.json"), "id INT, name STRING")
    assert {tuple(r) for r in read.collect()} == {(1, "São"), (2, None)}
