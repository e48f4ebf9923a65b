"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from compare import differences, twin
from hotdesk.oracle import ORACLE
from hotdesk.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return twin(sf_dir)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= registered.queries().keys() and ORACLE.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name]) == []


def test_entry(spark):
    rows = registered.entry(spark)
    assert rows.count() > 0 and "taxa_utilizacao_perc" in rows.columns
