"""Vault loads and the key index deal a batch once."""

import pytest
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.plans import vault_models as vm

COLUMNS = """transaction_unified_id string, source_entity_id string, source_system string, transaction_type string, transaction_category string,
amount decimal(28,9), currency_code string, transaction_date date, status string, reference_number string, memo string, _unified_at timestamp"""


@pytest.fixture()
def sort_merge(spark):
    """Joins as at size, and far more shuffle parts than the index has buckets."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def spine(spark):
    ids = spark.range(40).withColumn("n", F.col("id") % 30)  # ten rows twice
    return ids.selectExpr(
        "if(n = 7, null, concat('t', n)) transaction_unified_id", "if(n % 5 = 0, null, concat('e', n % 4)) source_entity_id",
        "if(n % 2 = 0, 'stripe', 'plaid') source_system", "'x' transaction_type", "'y' transaction_category",
        "cast(n as decimal(28,9)) amount", "'USD' currency_code", "date'2024-01-05' transaction_date", "'s' status",
        "cast(null as string) reference_number", "concat('m', id) memo", "timestamp'2024-01-05 06:00:00' _unified_at")


@pytest.mark.parametrize("load, shuffles", [(vm.hub_transaction, 2), (vm.lnk_transaction_account, 2), (vm.sat_transaction_details, 2)])
def test_a_load_dealt_once_has_the_same_rows(spark, sort_merge, load, shuffles):
    utx = spine(spark)
    first = utx.filter("amount < 12")
    want = load(utx, target=load(first))
    got = load(utx, target=load(first, deal_once=True), deal_once=True)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = load(utx, target=load(first, deal_once=True), deal_once=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == shuffles


def test_the_index_is_read_bucket_by_bucket(spark, sort_merge, tmp):
    index = sinks.KeyIndex(spark, f"{tmp}/t", ["k"], "p")
    index.add(spark.createDataFrame([("a", "1"), ("b", None), (None, "1")], "k string, p string"))
    index.add(spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None), ("c", None)], "k string, p string"))
    assert sorted(map(repr, index.table.read().collect())) == sorted(map(repr, spark.createDataFrame(
        [("a", "1"), ("b", None), (None, "1"), ("a", "2"), ("c", None)], "k string, _partition string").collect()))
    found = index.partitions(spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string"))
    assert {r[0] for r in found.collect()} == {"1", "2"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    scan = next(i for i, line in enumerate(plan.splitlines()) if "bucketed_" in line and "FileScan" in line)
    above = plan.splitlines()[:scan]
    join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[join:])
