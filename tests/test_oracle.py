"""Every registered query against its DuckDB oracle on sf0.01 (the driver's correctness gate)."""

import pytest

from __spark_entry__ import oracle_sql, queries
from innsight.oracle.compare import compare, duckdb_connection
from innsight.plans.queries import QUERIES

from conftest import SF_CHECK

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(name, queries()[name](spark, SF_CHECK), con, oracle_sql()[name])
    assert result.ok, str(result)
    assert result.spark_rows > 0, f"{name} returned no rows on {SF_CHECK}"
