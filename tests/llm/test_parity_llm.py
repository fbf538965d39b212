"""Queries with DuckDB SQL against it, on the smallest driver tables."""

import pytest

from cellflux.llm.queries import ORACLES, QUERIES
from corpora import SF_SMALL
from parity import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, msg
