"""Named queries against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from cargolens.registry.oracle import oracle_sql
from cargolens.registry.queries import queries
from tests.verify_queries import connect, difference

FOLDER = os.environ.get("CARGOLENS_TEST_FOLDER", "/root/testdata/sf0.001")
pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def as_in_production(spark):
    """Whole stages compiled, which the session of the other tests leaves out."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_result_as_sql(spark, database, name):
    assert difference(queries()[name](spark, FOLDER), database, oracle_sql()[name]) is None
