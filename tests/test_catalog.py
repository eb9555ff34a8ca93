"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from stratiform.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got, _, problems = compare(df, con, SQL[name])
    assert not problems
    assert got > 0


def test_every_sql_has_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())
