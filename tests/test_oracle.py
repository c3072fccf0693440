"""Every registered query against its SQL, over whole tables."""

import compare
import pytest

import __spark_entry__ as entry
import oracle
from retailloom.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL)
    assert set(SQL) <= set(entry.oracle_sql()) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns == ["country", "revenue"]
    assert entry.entry(spark).count() > 0
