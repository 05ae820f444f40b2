"""Every registered query against its DuckDB statement at sf0.01 (the correctness gate)."""

import pytest

import __spark_entry__ as entry
from enrichkit.plans import catalog
from tests.conftest import ORACLE_SF
from tools.compare_oracle import compare, duck

QUERIES = dict(catalog.QUERIES)
SQL = dict(catalog.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(ORACLE_SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], SQL.get(name), ORACLE_SF)
    assert result["status"] == "ok", result


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
