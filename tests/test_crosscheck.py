"""Every named query gives the rows of its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from brisa.catalog import ENTRIES
from tests.crosscheck import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_report_has_sql():
    """Only the optional text queries may lack it; those are tested beside their operators."""
    assert set(ENTRIES) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", ORACLE)
def test_same_rows(spark, duck, key):
    _, problem = compare(spark, duck, key, QUERIES[key], ORACLE[key], FOLDER)
    assert problem is None


def test_entry_runs(spark):
    result = contract.entry(spark)
    assert result.columns[:2] == ["day", "mean_pm25"]
    assert result.count() > 0
