"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect
from workload import oracle, queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(oracle.statements())
    assert set(queries.registered()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_query_matches_sql(spark, con, name):
    assert compare(queries.registered()[name](spark, SMALL), con, oracle.statements()[name]) is None


def test_comparison_notices_a_wrong_value(spark, con):
    df = spark.sql("SELECT 1L AS a, 2.0D AS b")
    assert compare(df, con, "SELECT 1::BIGINT AS a, 2.5::DOUBLE AS b") is not None
    assert compare(df, con, "SELECT 1::BIGINT AS a, 2.0::DOUBLE AS b") is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns
