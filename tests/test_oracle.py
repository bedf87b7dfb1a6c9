"""Every registered query against its oracle SQL on the smallest given tables."""

import pytest

import __spark_entry__ as entry
from warehaus.plans import catalog
from warehaus.oracle.compare import compare, duckdb_connection

from conftest import SF_SMALL

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert compare(df, ORACLE[key], con) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "summary_date" in df.columns
