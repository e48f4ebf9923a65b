"""The pipeline stage by stage, the twins, and what is registered."""

from __future__ import annotations

import brute
import duckdb
import pytest
from compare import differences

import __spark_entry__ as registered
import corpus_pipeline
from hotdesk.llm import decontaminate, pii, quality
from hotdesk.llm.queries import ORACLE, QUERIES
from hotdesk.llm.tables import read, stored


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= registered.queries().keys()
    assert ORACLE.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", ORACLE)
def test_twins(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == []


def test_stages_take_effect(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stored(stage(spark, docs, sf_dir), name)
        assert rows.columns == columns
        after = {r.doc_id: r.text for r in rows.collect()}
        gone = before.keys() - after.keys()
        if name == "quality_classifier":
            judged = quality.digest(docs, read(spark, sf_dir, "labels")).collect()
            assert gone == {r.doc_id for r in judged if not r.keep}
        elif name == "ngram_jaccard_join":
            groups = brute.near_copies(sorted(before.items()), 5, 80)
            assert after.keys() == {group for _, _, group in groups}
        elif name == "benchmark_decontamination":
            leaks = decontaminate.leaks(docs, read(spark, sf_dir, "benchmark")).collect()
            assert gone == {r.doc_id for r in leaks}
        else:
            spans = {r.doc_id: r.spans for r in pii.digest(docs).collect()}
            assert not gone
            assert all((before[d] != after[d]) == bool(spans[d]) for d in after)
        docs, before = rows, after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == before.keys()


def test_empty_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        read(spark, "/root/testdata/sf0.001", table).limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
