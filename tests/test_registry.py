"""The registered queries next to their SQL, as the driver runs them, and their plans."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, oracle_connection
from checks.registry import QUERIES, SQL
from tests.conftest import plan

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    assert compare(QUERIES[name](spark, SF_DIR), oracle, SQL[name]) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


LAZY = [n for n in QUERIES if not n.startswith(("csv_", "stream_", "landed", "result"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text
