"""What a merge leaves on disk: no copy of the batch that makes a table, short keys in the index, columns made after the exchange."""

import datetime as dt
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.plans.model import Model

D = dt.date
SF = "/root/testdata/sf0.001"


def rows_of(spark, path):
    return sorted((r.id, r.d, r.v) for r in sinks.read_table(spark, path).collect())


def test_a_table_is_made_without_a_copy_of_its_rows_and_a_merge_leaves_none(spark, tmp, monkeypatch):
    def stored(*a, **k):
        raise AssertionError("rows were checkpointed")

    monkeypatch.setattr(DataFrame, "checkpoint", stored)
    path, finish = tmp + "/t", lambda df: df.select(F.concat(F.lit("id-"), "k").alias("id"), *[c for c in df.columns if c != "k"])
    make = lambda *r: spark.createDataFrame(list(r), "k string, d date, v int, at timestamp")
    at = [dt.datetime(2024, 1, d, 6) for d in (1, 2)]
    marks = [("at", None, None)]
    first = make(("a", D(2024, 1, 5), 1, at[0]), ("b", None, 2, at[0]), ("b2", D(2024, 3, 1), 2, at[0]))
    assert sinks.upsert(first, path, "id", ("d", "month"), ["v"], watermarks=marks, finish=finish) == "created"
    assert not Path(path + "__batch").exists() and sinks.watermark(spark, path, "at") == at[0]
    batch = make(("a", D(2024, 2, 5), 10, at[1]), ("b", D(2024, 3, 2), 20, at[1]), ("n", None, 3, at[1]))
    assert sinks.upsert(batch, path, "id", ("d", "month"), ["v"], watermarks=marks, finish=finish) == "merged"
    assert sinks.upsert(batch.limit(0), path, "id", ("d", "month"), ["v"], finish=finish) == "noop"
    assert rows_of(spark, path) == [("id-a", D(2024, 2, 5), 10), ("id-b", D(2024, 3, 2), 20), ("id-b2", D(2024, 3, 1), 2), ("id-n", None, 3)]
    assert not Path(path + "__batch").exists() and sinks.watermark(spark, path, "at") == at[1]


def test_string_keys_are_indexed_by_their_hash_and_null_keys_not(spark, tmp):
    path = tmp + "/t"
    rows = spark.createDataFrame([("a", "x", D(2024, 1, 5)), ("a", None, D(2024, 1, 5)), ("b", "x", None)], "k string, l string, d date")
    for _ in range(2):  # rows with a NULL key are added each time
        sinks.upsert(rows, path, ["k", "l"], ("d", "month"))
    assert sinks.read_table(spark, path).count() == 4
    index = sinks.HashedKeyIndex(spark, path, ["k", "l"], "d_month")
    assert index.table.read().dtypes == [("_key", "bigint"), ("_partition", "string")] and index.table.read().count() == 2
    # other keys are kept as they are: an int that becomes a long keeps its place
    sinks.upsert(rows.select(F.lit(5).alias("k"), "d").limit(1), path + "i", "k", ("d", "month"))
    sinks.upsert(spark.createDataFrame([(5, D(2024, 4, 1))], "k long, d date"), path + "i", "k", ("d", "month"))
    assert [tuple(r) for r in sinks.read_table(spark, path + "i").collect()] == [(5, D(2024, 4, 1), "2024-04")]


def test_the_buckets_of_an_index_follow_its_keys(spark, tmp, monkeypatch):
    monkeypatch.setattr(sinks, "BUCKET_KEYS", 10)
    rows = spark.range(400).select(F.col("id").cast("string").alias("k"), F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("d"))
    sinks.upsert(rows, tmp + "/t", "k", ("d", "month"))
    assert sinks.HashedKeyIndex(spark, tmp + "/t", ["k"], "d_month").table.buckets == 40


def test_the_merged_spine_is_dealt_without_its_ids(spark, monkeypatch):
    import table_queries

    m, dealt, real = Model.from_driver(spark, SF), [], sinks._dealt
    monkeypatch.setattr(sinks, "_dealt", lambda df, *a: (dealt.append(df.columns), real(df, *a))[1])
    for query in (table_queries.upsert_moved_and_null_dates, table_queries.noted_watermarks):
        dealt.clear()
        query(m)
        assert "transaction_unified_id" not in dealt[0] and "_unified_at" not in dealt[0]


def test_rows_that_a_batch_replaces_go_before_their_columns_are_made(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    finish = lambda df: df.select(F.md5("k").alias("id"), "v", (F.col("v") * 2).alias("twice"))
    batch = finish(spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int"))
    got = sinks.merge_frames(rows, batch, ["id"], key_of={"id": F.md5("k")}, finish=finish, batch_keys=batch.select("id"))
    want = sinks.merge_frames(finish(rows), batch, ["id"])
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 5


def test_the_incremental_fact_table_is_joined_and_merged_on_narrow_rows(spark):
    import query_registry

    plan = query_registry.REGISTRY["f10_fct_transactions_incremental"].spark(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    anti = [i for i, line in enumerate(lines) if "Join LeftAnti" in line]
    outer = [i for i, line in enumerate(lines) if "Join LeftOuter" in line]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    # every merge lies below a customer join or beside it, none above: whole fact rows are not dealt again
    assert anti and not any(depth(lines[i]) < depth(lines[j]) and i < j and all(depth(x) > depth(lines[i]) for x in lines[i + 1:j + 1])
                            for i in anti for j in outer)
