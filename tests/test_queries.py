"""Registered queries against DuckDB on the smallest tables."""

import compare
import pytest

import __spark_entry__ as driver
from ledgerloom.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    same, line = compare.compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert same, line


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
