"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import pytest

from conftest import SF_SMALL
from parity import compare, duck

import __spark_entry__ as entry
from cellflux import catalog, oracle

QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["gid", "pm10_tot", "pm25_tot"]
    assert df.count() == 3000
