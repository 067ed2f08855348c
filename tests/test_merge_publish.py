"""Merges, rebuilds and snapshots that are exact per partition and survive being cut off."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.operators import snapshot
from ledgerlake.sinks import publish
from ledgerlake.sinks.bucketed import BucketedTable

D = dt.date
SCHEMA = "k string, d date, v int"


def rows_of(spark, path, cols=("k", "d", "v")):
    return sorted((tuple(r[c] for c in cols) for r in sinks.read_table(spark, path).collect()), key=str)


def merge(target: dict, batch: list):
    return {**target, **{r[0]: r for r in batch}}


@pytest.mark.parametrize("grain", ["month", "day"])
def test_only_key_of_a_partition_moves_and_null_dates_are_a_partition(spark, tmp, grain):
    path = tmp + "/t"
    first = [("a", D(2024, 1, 5), 1), ("b", None, 2), ("c", D(2024, 3, 1), 3), ("n", None, 9)]
    sinks.upsert(spark.createDataFrame(first, SCHEMA), path, "k", partition_by=("d", grain))
    # a leaves January, where it was alone; b gets a date; c loses its; n is touched by nobody
    batch = [("a", D(2024, 2, 5), 10), ("b", D(2024, 3, 2), 20), ("c", None, 30)]
    assert sinks.upsert(spark.createDataFrame(batch, SCHEMA), path, "k", partition_by=("d", grain)) == "merged"
    assert rows_of(spark, path) == sorted(batch + [first[3]], key=str)
    # the last dated rows go to NULL: their folders are gone, not left with old rows
    batch = [("a", None, 11), ("b", None, 21)]
    sinks.upsert(spark.createDataFrame(batch, SCHEMA), path, "k", partition_by=("d", grain))
    assert rows_of(spark, path) == sorted(batch + [("c", None, 30), first[3]], key=str)
    assert publish.Files(spark, path).folders(path) == [f"d_{grain}={publish.NULL_PARTITION}"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_merges_equal_a_dictionary(spark, tmp_path_factory, data):
    path = str(tmp_path_factory.mktemp("m")) + "/t"
    row = st.tuples(st.sampled_from("abcdefg"), st.one_of(st.none(), st.sampled_from([D(2024, m, 3) for m in (1, 2, 3)])), st.integers(0, 9))
    state = {}
    for i in range(3):
        batch = list({r[0]: r for r in data.draw(st.lists(row, min_size=1, max_size=5))}.values())
        sinks.upsert(spark.createDataFrame(batch, SCHEMA), path, "k", partition_by=("d", "month"), cluster_by=["v"] if i else None)
        state = merge(state, batch)
        assert rows_of(spark, path) == sorted(state.values(), key=str)


def test_a_merge_reads_the_touched_months_alone(spark, tmp):
    path = tmp + "/t"
    rows = [(f"k{m}-{i}", D(2023, m, 1 + i), i) for m in range(1, 13) for i in range(20)]
    sinks.upsert(spark.createDataFrame(rows, SCHEMA), path, "k", partition_by=("d", "month"))
    files = publish.Files(spark, path)
    old = {m: [f.name for f in (__import__("pathlib").Path(path) / f"d_month=2023-{m:02d}").iterdir()] for m in range(1, 13)}
    for m in range(1, 11):  # months that are not touched may even be unreadable
        for f in (__import__("pathlib").Path(path) / f"d_month=2023-{m:02d}").iterdir():
            if f.suffix == ".parquet":
                f.write_bytes(b"not parquet")
    sinks.upsert(spark.createDataFrame([("k11-3", D(2023, 12, 30), 99), ("new", D(2023, 12, 31), 5)], SCHEMA), path, "k", partition_by=("d", "month"))
    now = sinks.read_table(spark, path).filter("d_month >= '2023-11'")
    assert now.count() == 41 and now.filter("k = 'k11-3'").collect()[0].d == D(2023, 12, 30)
    assert files.folders(path) == [f"d_month=2023-{m:02d}" for m in range(1, 13)]
    for m in range(1, 11):
        assert old[m] == [f.name for f in (__import__("pathlib").Path(path) / f"d_month=2023-{m:02d}").iterdir()]


def test_a_target_without_an_index_gets_one(spark, tmp):
    path = tmp + "/t"
    sinks.write_table(spark.createDataFrame([("a", D(2024, 1, 5), 1), ("b", None, 2)], SCHEMA), path, ("d", "month"))
    sinks.upsert(spark.createDataFrame([("a", None, 3), ("b", D(2024, 2, 2), 4)], SCHEMA), path, "k", partition_by=("d", "month"))
    assert rows_of(spark, path) == [("a", None, 3), ("b", D(2024, 2, 2), 4)]


class Cut(Exception):
    pass


@pytest.mark.parametrize("step", range(9))
def test_a_merge_cut_off_at_any_file_operation_is_finished_or_undone(spark, tmp, step, monkeypatch):
    path = tmp + "/t"
    first = [("a", D(2024, 1, 5), 1), ("b", None, 2), ("c", D(2024, 3, 1), 3)]
    batch = [("a", D(2024, 3, 5), 10), ("b", D(2024, 2, 2), 20)]
    sinks.upsert(spark.createDataFrame(first, SCHEMA), path, "k", partition_by=("d", "month"))
    left = [step]
    # the publish's own operations alone are counted: moves and deletes after the staged files are written
    whole = {n: getattr(publish.Files, n) for n in ("move", "delete")}

    def counted(name):
        def f(self, *a):
            if armed and not any("__keys" in x for x in a):
                if left[0] == 0:
                    raise Cut
                left[0] -= 1
            return whole[name](self, *a)
        return f

    armed = []
    real = publish.publish_folders
    for n in whole:
        monkeypatch.setattr(publish.Files, n, counted(n))
    monkeypatch.setattr(sinks, "publish_folders", lambda *a: (armed.append(1), real(*a))[1])
    try:
        sinks.upsert(spark.createDataFrame(batch, SCHEMA), path, "k", partition_by=("d", "month"))
        cut_off = False
    except Cut:
        cut_off = True
    monkeypatch.undo()
    old, new = sorted(first, key=str), sorted(merge({r[0]: r for r in first}, batch).values(), key=str)
    got = rows_of(spark, path)
    assert got in (old, new) and (cut_off or got == new)
    # and the run that is repeated makes it right
    sinks.upsert(spark.createDataFrame(batch, SCHEMA), path, "k", partition_by=("d", "month"))
    assert rows_of(spark, path) == new


def test_a_rebuild_cut_off_between_its_moves_is_no_first_run(spark, tmp):
    path = tmp + "/t"
    sinks.write_table(spark.createDataFrame([("a", D(2024, 1, 5), 1)], SCHEMA), path)
    files = publish.Files(spark, path)
    # as a run leaves it that dies after the old table went and before the new one came
    spark.createDataFrame([("z", D(2024, 1, 5), 7)], SCHEMA).write.parquet(publish.staged_path(path))
    files.write(path + "__publish", json.dumps({"whole": True}))
    files.delete(path)
    assert sinks.table_exists(spark, path)
    assert rows_of(spark, path) == [("z", D(2024, 1, 5), 7)]


def test_a_failed_rebuild_leaves_the_table(spark, tmp):
    path = tmp + "/t"
    sinks.write_table(spark.createDataFrame([("a", D(2024, 1, 5), 1)], SCHEMA), path, ("d", "month"))
    bad = spark.range(10).select(F.lit("x").alias("k"), F.lit(D(2024, 1, 1)).alias("d"),
                                 F.when(F.col("id") > 3, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("int").alias("v"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(bad, path, ("d", "month"))
    assert rows_of(spark, path) == [("a", D(2024, 1, 5), 1)]
    assert not publish.Files(spark, path).exists(publish.staged_path(path))


def test_columns_are_added_widened_and_missed(spark, tmp):
    path = tmp + "/t"
    sinks.upsert(spark.createDataFrame([("a", D(2024, 1, 5), 1, 1.5, "x"), ("b", D(2024, 2, 5), 2, 2.5, "y")],
                                       "k string, d date, v int, f float, gone string"), path, "k", partition_by=("d", "month"))
    big = 1 << 40
    batch = spark.createDataFrame([("b", D(2024, 3, 5), big, 0.1, "new")], "k string, d date, v long, f double, added string")
    sinks.upsert(batch, path, "k", partition_by=("d", "month"))
    assert rows_of(spark, path, ("k", "v", "f", "gone", "added")) == [("a", 1, 1.5, "x", None), ("b", big, 0.1, None, "new")]
    # a narrower batch is cast up, and appended too
    sinks.write_table(spark.createDataFrame([("c", D(2024, 1, 9), 3)], SCHEMA), path, ("d", "month"), mode="append")
    assert dict(sinks.read_table(spark, path).dtypes)["v"] == "bigint"
    assert rows_of(spark, path, ("k", "v")) == [("a", 1), ("b", big), ("c", 3)]
    with pytest.raises(TypeError, match="v: string"):
        sinks.upsert(spark.createDataFrame([("c", D(2024, 1, 9), "3")], "k string, d date, v string"), path, "k", partition_by=("d", "month"))
    assert rows_of(spark, path, ("k", "v")) == [("a", 1), ("b", big), ("c", 3)]


def test_widening_rules():
    from pyspark.sql import types as T

    from ledgerlake.sinks.schemas import wider
    assert wider(T.DecimalType(18, 4), T.DecimalType(28, 9)) == T.DecimalType(28, 9)
    assert wider(T.DecimalType(18, 4), T.LongType()) == T.DecimalType(24, 4)
    assert wider(T.ShortType(), T.IntegerType()) == T.IntegerType()
    assert wider(T.DecimalType(38, 0), T.DecimalType(10, 9)) is None
    assert wider(T.LongType(), T.DoubleType()) is None and wider(T.StringType(), T.IntegerType()) is None


def test_watermarks_are_noted_while_writing(spark, tmp):
    path = tmp + "/t"
    t = [dt.datetime(2024, 1, d, 6) for d in (1, 2, 3)]
    make = lambda *r: spark.createDataFrame(list(r), "k string, s string, at timestamp")
    marks = [("at", "s", ["x", "y"]), ("at", None, None)]
    assert sinks.watermark(spark, path, "at") is None and sinks.watermark(spark, path, "at", by=True) == {}
    sinks.upsert(make(("a", "x", t[0]), ("b", "x", t[1]), ("c", "y", None)), path, "k", watermarks=marks)
    assert sinks.watermark(spark, path, "at") == t[1] and sinks.watermark(spark, path, "at", by=True) == {"x": t[1]}
    sinks.upsert(make(("d", "y", t[2]), ("e", "x", t[0])), path, "k", watermarks=marks)
    assert sinks.watermark(spark, path, "at") == t[2] and sinks.watermark(spark, path, "at", by=True) == {"x": t[1], "y": t[2]}


# bucketed tables and insert-only loads ---------------------------------------

def exchanges_under(plan: str) -> list[str]:
    """The plan's lines from the scan of a bucketed table up to the join."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    join = max(i for i, x in enumerate(lines[:at]) if "Join" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    own = [x for i, x in enumerate(lines[join + 1:at], join + 1) if depth(x) < depth(lines[at]) and all(
        depth(y) > depth(x) for y in lines[i + 1:at + 1])]
    return [x for x in own if "Exchange" in x]


def test_anti_join_shuffles_the_batch_alone(spark, tmp):
    from ledgerlake.operators.joins import anti_join_target

    rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    BucketedTable(spark, tmp + "/b", ["k"], 4).append(rows.filter("id < 1000"))
    BucketedTable(spark, tmp + "/b", ["k"], 7).append(rows.filter("id between 1000 and 1999"))
    table = BucketedTable(spark, tmp + "/b", ["k"])
    assert table.buckets == 4
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = anti_join_target(rows, table.read(), ["k"])
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and exchanges_under(plan) == []
        assert new.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    with pytest.raises(ValueError):
        BucketedTable(spark, tmp + "/b", ["id"])


# snapshot ---------------------------------------------------------------------

T = [dt.datetime(2024, 1, d, 6) for d in (1, 2, 3, 4)]


def versions(spark, path):
    return sorted(((r.k, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in sinks.read_snapshot(spark, path).collect()), key=str)


def test_snapshot_zones_hold_every_version(spark, tmp):
    path = tmp + "/s"
    make = lambda *r: spark.createDataFrame(list(r), "k string, v string, u timestamp")
    runs = [make(("a", "1", T[0]), ("b", "1", T[0]), ("c", "1", T[0])),
            make(("a", "2", T[1]), ("b", "1", T[0])),                     # a changed, b same, c deleted
            make(("a", "2", T[1]), ("b", "1", T[0]), ("c", "3", T[2])),   # c is back
            make()]                                                       # all deleted
    frame = None
    for i, current in enumerate(runs):
        closed = set(publish.Files(spark, path).folders(path + "/_zone=closed"))
        sinks.write_snapshot(current, path, "k", "u", T[i])
        frame = snapshot.snapshot(current, frame, "k", "u", T[i])
        assert versions(spark, path) == sorted(((r.k, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in frame.collect()), key=str)
        assert closed <= set(publish.Files(spark, path).folders(path + "/_zone=closed"))
    assert publish.Files(spark, path).folders(path) == ["_zone=closed"]
    open_scan = sinks.read_snapshot(spark, path, open_only=True)
    assert "PartitionFilters: [isnotnull(_zone" in open_scan._jdf.queryExecution().executedPlan().toString() and open_scan.count() == 0


def test_repeated_and_failed_snapshot_runs_lose_nothing(spark, tmp):
    path = tmp + "/s"
    make = lambda *r: spark.createDataFrame(list(r), "k string, v string, u timestamp")
    sinks.write_snapshot(make(("a", "1", T[0]), ("b", "1", T[0])), path, "k", "u", T[0])
    second = make(("a", "2", T[1]))
    sinks.write_snapshot(second, path, "k", "u", T[1])
    want = versions(spark, path)
    sinks.write_snapshot(second, path, "k", "u", T[1])
    assert versions(spark, path) == want
    bad = second.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_snapshot(bad, path, "k", "u", T[2])
    assert versions(spark, path) == want
    # a column more in the dimension: older versions have none
    sinks.write_snapshot(make(("a", "3", T[2])).withColumn("w", F.lit(5)), path, "k", "u", T[2])
    got = {(r.v, r.w) for r in sinks.read_snapshot(spark, path).filter("k = 'a'").collect()}
    assert got == {("1", None), ("2", None), ("3", 5)}
