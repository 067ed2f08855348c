"""What the jobs on the spine shuffle: rows that a join needs, columns that nothing makes later."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.operators.joins import left_join_matchable, left_join_spread
from ledgerlake.plans import intermediate, marts
from ledgerlake.plans.model import Model

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def under(df, node):
    """The lines of the plan below its first ``node``."""
    lines = plan_of(df).splitlines()
    top = next(i for i, line in enumerate(lines) if node in line)
    depth = lines[top].index(node)
    end = next((i for i in range(top + 1, len(lines)) if not set(lines[i][:depth + 1]) <= set(" :+-")), len(lines))
    return "\n".join(lines[top + 1:end])


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_rows_that_cannot_match_are_beside_the_join(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "b", "y"), (4, "a", None), (5, "c", "x"), (5, "c", "x")], "id int, k string, s string")
    right = spark.createDataFrame([("a", "x", 7), ("a", "x", 8), ("b", "y", 9), (None, "x", 1)], "rk string, rs string, v int")
    pairs, ok = [("k", "rk"), ("s", "rs")], F.col("s") == "x"
    got = left_join_matchable(left, right.hint("merge"), pairs, matchable=ok)
    want = left_join_spread(left, right, pairs, spread_col="id", matchable=ok)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    assert got.filter("v is null").count() == 5  # b/y is not matchable


def test_the_fact_table_hashes_ids_after_the_join(spark):
    m = Model.from_driver(spark, SF)
    fct = marts.fct_transactions(m.spine_rows, m.golden, m._with_ids)
    below = under(fct, "SortMergeJoin")  # the lookup is not broadcast on an estimate
    assert below.count("Exchange hashpartitioning") == 2 and "md5(" not in below
    whole = marts.fct_transactions(intermediate.unified_transactions(m.stg, m.p), m.golden)
    assert fct.exceptAll(whole).isEmpty() and whole.exceptAll(fct).isEmpty()


def test_columns_made_after_the_exchange_are_in_the_table(spark, tmp):
    rows = spark.createDataFrame([("a", dt.date(2024, 1, 5)), ("b", dt.date(2024, 2, 5)), ("c", None), ("c", None)], "k string, d date")
    sinks.write_table(rows, f"{tmp}/t", ("d", "month"), finish=lambda df: df.withColumn("id", F.md5("k")))
    got = sinks.read_table(spark, f"{tmp}/t")
    assert got.columns == ["k", "d", "id", "d_month"]
    assert got.filter(F.col("id") == F.md5("k")).count() == 4


def test_a_snapshot_run_deals_no_rows_to_its_folders(spark, tmp, monkeypatch):
    def dealt(*a):
        raise AssertionError("rows were dealt")

    monkeypatch.setattr(sinks, "_dealt", dealt)
    for day, keys in ((1, "abc"), (2, "bcd")):
        at = dt.datetime(2024, 1, day)
        current = spark.createDataFrame([(k, Decimal(1), at) for k in keys], "k string, v decimal(9,2), at timestamp")
        sinks.write_snapshot(current, f"{tmp}/s", "k", "at", at)
    got = sinks.read_snapshot(spark, f"{tmp}/s")
    assert got.count() == 6 and got.filter("dbt_valid_to is null").count() == 3
