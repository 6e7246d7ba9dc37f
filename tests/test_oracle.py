"""Every registered query with an SQL twin gives the same rows in DuckDB (sf0.001)."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    ok, note = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
