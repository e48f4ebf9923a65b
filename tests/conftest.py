from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]


@pytest.fixture(scope="session")
def spark():
    from compare import session

    spark = session("8")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark, tmp_path):
    from uuid import uuid4

    from hotdesk.sources.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse"), f"test_{uuid4().hex[:12]}")
