"""Every check query that has SQL must give DuckDB's rows exactly."""

from __future__ import annotations

import pytest
from harness import compare, duck

import __spark_entry__ as entry

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, ORACLE[name]) == []


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 93 and df.columns[:2] == ["ip_a", "ip_b"]
