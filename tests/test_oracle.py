"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import os
import sys

import pytest

import __spark_entry__ as entry
from starloom.plans import catalog, oracle
from tests.paths import ROOT, SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import compare, duck_connection  # noqa: E402

#: The warehouse queries; those of the optional subpackage have tests beside it.
QUERIES = catalog.REGISTRY
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SMALL, name, QUERIES[name], SQL.get(name), con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "sales_sk" in df.columns
