"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql
from query_registry import REGISTRY
from tests.oracle_compare import compare, duck_con

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck_con(SF)


def test_every_query_has_an_oracle():
    missing = sorted(set(REGISTRY) - set(oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SF)
    assert r.get("cols_match"), r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r.get("values_match"), r


def test_entry_runs(spark):
    df = entry(spark)
    assert set(df.columns) >= {"aging_bucket", "invoice_count"}
    assert df.count() >= 1
