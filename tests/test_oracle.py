"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import os

import pytest

import __spark_entry__ as entry
from pricelake.plans.catalog import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["trade_date", "portfolio_value"]
    assert df.count() > 0
