"""Every registered query against its independent SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

CHECKS = entry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in entry.QUERIES}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_check_sql():
    assert set(QUERIES) <= set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, con, name):
    assert compare(QUERIES[name](spark, small), con, CHECKS[name]) == []


def test_comparison_notices_differences(spark):
    con = duckdb.connect()
    df = spark.sql("select 1 as a, cast(2.5 as decimal(18,8)) as m")
    assert compare(df, con, "select 1 as a, cast(2.5 as decimal(18,8)) as m") == []
    assert compare(df, con, "select 1 as a, cast(2.6 as decimal(18,8)) as m")
    assert compare(df, con, "select 1 as b, cast(2.5 as decimal(18,8)) as m")
    assert compare(df, con, "select 1::bigint as a, cast(2.5 as decimal(18,8)) as m")
    assert compare(df, con, "select 1 as a, cast(2.5 as decimal(18,8)) as m from range(2)")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
