"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["status"] == "match", r
