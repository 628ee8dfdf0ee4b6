"""Every registered query against its SQL on DuckDB."""

import pytest
from conftest import SF_DIR
from oracle import compare, connect

import __spark_entry__ as entrypoint

QUERIES, SQL = entrypoint.queries(), entrypoint.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0
