"""Every named query against its SQL on the smallest data folder; those without SQL must give rows."""

from __future__ import annotations

import __spark_entry__ as entry_point
import compare
import pytest

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    rows = compare.spark_rows(QUERIES[name](spark, FOLDER))
    assert compare.difference(rows, compare.sql_rows(connection, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
