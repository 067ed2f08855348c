"""Materializations S3-S5, S14-S22 over plain parquet directories.

* ``write_table``     full rebuild (S3/S15), optional month/day partitions of a
                      date/timestamp column (S19/S20) and clustering (S21)
* ``append``          insert-only append; an empty batch leaves the target alone (S4/S5)
* ``upsert``          replace rows by unique key, insert new ones (S16), first
                      run = full build (S17), schema changes (S18, ``schemas``)
* ``write_snapshot``  SCD2 history in an open and a closed zone (S22)
* ``view``            temp view (S14)
* ``watermark``       high watermarks noted while writing (A7, F10, F11)

No lakehouse format is bundled. Rebuilds, merges and snapshots write their
new files beside the table and then put them in place (``publish``); an
interrupted publish is finished or undone by the next call. The batch of a
merge is cut from its lineage into compressed Parquet files beside the table
-- never in a machine-local folder -- so it is computed once and a lost
executor re-reads it; they go when the merge ends. The batch that makes a
table is stored nowhere else: its rows go straight to the table's files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.operators.snapshot import VERSION_COLS, advance, first_snapshot
from ledgerlake.session import checkpoint_dir
from ledgerlake.sinks.bucketed import BUCKETS, BucketedTable
from ledgerlake.sinks.publish import (NULL_PARTITION, SCHEMA_FILE, Files, publish_folders, publish_whole, recover,
                                      staged_path)
from ledgerlake.sinks.schemas import conform, reconciled, stored_schema


def table_exists(spark: SparkSession, path: str) -> bool:
    """S17 switch: is there a readable parquet table at ``path``? An
    interrupted publish is finished first, so it never looks like a first run."""
    recover(spark, path)
    if stored_schema(spark, path) is not None:
        return True
    try:
        spark.read.parquet(path).schema  # noqa: B018 - resolves the file listing only
        return True
    except AnalysisException as e:  # any other error must not look like a first run
        if (e.getCondition() or "") in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table under its stored schema (S18); a folder written without one merges its files' schemas."""
    recover(spark, path)
    schema = stored_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _partition_value(col: str, grain: str) -> Column:
    if grain == "month":
        return F.date_format(F.col(col), "yyyy-MM")
    if grain == "day":
        return F.to_date(F.col(col))
    raise ValueError(grain)


def partition_column(df: DataFrame, col: str, grain: str) -> tuple[DataFrame, str]:
    """Derive the partition value of a DATE/TIMESTAMP column: 'month' -> yyyy-MM, 'day' -> date."""
    name = f"{col}_{grain}"
    return df.withColumn(name, _partition_value(col, grain)), name


def view(df: DataFrame, name: str) -> DataFrame:
    """Register a staging model as a temp view."""
    df.createOrReplaceTempView(name)
    return df


def _dealt(df: DataFrame, parts: list[str], cluster_by: list[str], seen: _Seen | None = None) -> DataFrame:
    """Rows of a partition value in few files, but many tasks: a range
    exchange over (partition, cluster columns) splits a large month by its
    cluster columns, a rebalance lets the runtime split it by size. The sort
    gives tight parquet statistics. ``seen`` counts the dealt rows, so that
    a range exchange's sampling does not count them too."""
    if parts and cluster_by:
        df = df.repartitionByRange(*[F.col(c) for c in [*parts, *cluster_by]])
    elif parts:
        df = df.hint("rebalance", *parts)
    df = seen.by(df) if seen else df
    if parts or cluster_by:
        df = df.sortWithinPartitions(*parts, *cluster_by)
    return df


def _write(df: DataFrame, path: str, parts: list[str], cluster_by: list[str], mode: str,
           finish: Callable[[DataFrame], DataFrame] | None = None, seen: _Seen | None = None) -> None:
    out = _dealt(df, parts, cluster_by, seen)
    w = (finish(out) if finish else out).write.mode(mode).option("partitionOverwriteMode", "static")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, str] | None = None,
    cluster_by: list[str] | None = None,
    mode: str = "overwrite",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """S3/S15 (+S19/S20/S21). ``partition_by`` = (column, 'month'|'day').
    ``finish`` (of a rebuild) makes columns row by row once the rows are
    dealt, so that columns which follow from others are not shuffled.

    A rebuild is staged: until the new table is complete the old one stays,
    and a failed rebuild leaves it. ``mode='append'`` adds files in place."""
    out, parts = df, []
    if partition_by:
        out, pcol = partition_column(out, *partition_by)
        parts = [pcol]
    if mode == "append":
        recover(df.sparkSession, path)
        stored = stored_schema(df.sparkSession, path)
        if stored is not None:
            schema = reconciled(stored, out.schema)
            out = conform(out, schema)
            if schema != stored:
                Files(df.sparkSession, path).write(f"{path}/{SCHEMA_FILE}", schema.json())
        _write(out, path, parts, cluster_by or [], "append")
        if stored is None:
            Files(df.sparkSession, path).write(f"{path}/{SCHEMA_FILE}", _ordered(out.schema, parts).json())
        return
    recover(df.sparkSession, path)
    _stage(out, path, parts, cluster_by or [], finish)
    publish_whole(df.sparkSession, path)


def _stage(df: DataFrame, path: str, parts: list[str], cluster_by: list[str],
           finish: Callable[[DataFrame], DataFrame] | None = None, seen: _Seen | None = None) -> DataFrame:
    """Write the whole new table beside the old one; the rows as they lie there."""
    spark, staged = df.sparkSession, staged_path(path)
    _write(df, staged, parts, cluster_by, "overwrite", finish, seen)
    schema = _ordered((finish(df) if finish else df).schema, parts)
    Files(spark, staged).write(f"{staged}/{SCHEMA_FILE}", schema.json())
    return spark.read.schema(schema).parquet(staged)


def _ordered(schema: StructType, parts: list[str]) -> StructType:
    """Nullable, partition columns last, as files are read back."""
    fields = [f for f in schema if f.name not in parts] + [f for f in schema if f.name in parts]
    return StructType([StructField(f.name, f.dataType, True) for f in fields])


def append(df: DataFrame, path: str, partition_by: tuple[str, str] | None = None) -> bool:
    """S4 append; S5 an empty batch is a no-op. Returns whether anything was written."""
    if df.isEmpty():
        return False
    write_table(df, path, partition_by=partition_by, mode="append")
    return True


def merge_frames(target: DataFrame, batch: DataFrame, keys: list[str], key_of: dict[str, Column] | None = None,
                 finish: Callable[[DataFrame], DataFrame] | None = None, batch_keys: DataFrame | None = None) -> DataFrame:
    """S16 as a pure DataFrame op: target rows whose key is not in the batch,
    plus the batch (new columns allowed, S18).

    ``target`` may be the narrower rows that ``finish`` makes the target of,
    each for itself: then the rows that the batch replaces go first, by
    ``key_of`` (the key columns, from the narrower ones), and the columns that
    follow from others are not shuffled. ``batch_keys``: the batch's keys, from
    fewer steps than the batch."""
    new = (batch if batch_keys is None else batch_keys).select(*keys).distinct()
    stays = target.join(new, [key_of[k] == new[k] for k in keys] if key_of else keys, "left_anti")
    return (finish(stays) if finish else stays).unionByName(batch, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# key index: where may a key live?
# ---------------------------------------------------------------------------
class KeyIndex:
    """The partition values a key has ever been written under, as a narrow
    bucketed table (key columns, partition) beside the target.

    Entries are only added, and before the publish that needs them: a publish
    that is undone leaves entries too many, never too few. So the partitions
    named here hold every row of a key, whatever was interrupted, and a merge
    reads no key of any other partition of the target."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], pcol: str, name: str = "__keys", buckets: int = BUCKETS):
        self.keys, self.pcol = keys, pcol
        self.table = BucketedTable(spark, path.rstrip("/") + name, keys, buckets)

    def add(self, rows: DataFrame) -> None:
        pairs = self.table.dealt(rows.select(*self.keys, F.col(self.pcol).cast("string").alias("_partition"))).distinct()
        known = self.table.read()
        if known is not None:
            # the partitions are compared row by row, they are no join key: the buckets are dealt by the keys alone
            new, old = pairs["_partition"], known["_partition"]
            same = F.when(new.isNull(), old.isNull()).otherwise(F.coalesce(new == old, F.lit(False)))
            pairs = pairs.join(known, [*[pairs[k] == known[k] for k in self.keys], same], "left_anti")
        self.table.append(pairs, dealt=True)

    def partitions(self, keys: DataFrame) -> DataFrame:
        """The distinct partition values (as strings) under which ``keys`` may live."""
        return self.table.read().join(self.table.dealt(keys).distinct(), self.keys, "left_semi").select("_partition").distinct()


#: keys of a bucket of a new index: its sort stays in a task's memory
BUCKET_KEYS = 2_000_000
KEY_HASH = "_key"


class HashedKeyIndex(KeyIndex):
    """The same for keys of strings, by their 64-bit hash: a few bytes a key,
    where ids that are themselves hashes in letters take five times that in
    every shuffle and file. Two keys of one hash name a partition too many.

    Strings stay strings (``schemas``), so a key's hash never changes. Rows
    with a NULL key never match and are left out."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], pcol: str, rows: int = 0):
        super().__init__(spark, path, [KEY_HASH], pcol, "__keys_hashed", max(BUCKETS, -(-rows // BUCKET_KEYS)))
        self.of = keys

    def _hashed(self, rows: DataFrame) -> DataFrame:
        given = rows.dropna(subset=self.of)
        return given.withColumn(KEY_HASH, F.xxhash64(*self.of))

    def add(self, rows: DataFrame) -> None:
        super().add(self._hashed(rows))

    def partitions(self, keys: DataFrame) -> DataFrame:
        return super().partitions(self._hashed(keys).select(KEY_HASH))


def _key_index(rows: DataFrame, path: str, keys: list[str], pcol: str, count: int = 0) -> KeyIndex:
    """The index for the key columns of ``rows``; ``count`` sets the buckets of a new one."""
    if all(isinstance(rows.schema[k].dataType, StringType) for k in keys):
        return HashedKeyIndex(rows.sparkSession, path, keys, pcol, count)
    return KeyIndex(rows.sparkSession, path, keys, pcol)


def _values(df: DataFrame) -> set:
    """A column of partition values: one per month or day of the table, so few."""
    return {None if r[0] is None else str(r[0]) for r in df.distinct().collect()}


def _in(pcol: str, values: set) -> Column:
    """Rows of the partitions ``values``: literals, so other folders are not read."""
    known = sorted(v for v in values if v is not None)
    out = F.col(pcol).isin(known) if known else F.lit(False)
    return out | F.col(pcol).isNull() if None in values else out


def upsert(
    batch: DataFrame,
    path: str,
    unique_key: str | list[str],
    partition_by: tuple[str, str] | None = None,
    cluster_by: list[str] | None = None,
    keys_may_move: bool = True,
    watermarks: list[tuple[str, str | None, list | None]] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """S16 merge on ``unique_key``; returns 'created', 'merged' or 'noop'.

    Partitioned targets: only the touched partitions are read and replaced,
    those of the batch's rows and those where a batch key lives now. The
    latter are looked up in the key index (``KeyIndex``) and checked in the
    partitions it names. A partition the merge empties is dropped; NULL
    dates are a partition like any other. A table whose partition value never
    changes for a key can pass ``keys_may_move=False``: it keeps no index.

    Columns and types may change by the rules of ``schemas``. Rows with a
    NULL key never match and are added. ``watermarks``: (column, by column,
    values of it) to note, see ``watermark``. ``finish`` makes columns of the
    batch row by row (the key may be one, a column to note not), as in ``write_table``.
    """
    spark = batch.sparkSession
    keys = [unique_key] if isinstance(unique_key, str) else list(unique_key)
    if checkpoint_dir(spark) is None:
        raise RuntimeError("spark.checkpoint.dir is not set; upsert needs a shared checkpoint folder")
    pcol = f"{partition_by[0]}_{partition_by[1]}" if partition_by else None
    if not table_exists(spark, path):
        rows = partition_column(batch, *partition_by)[0] if partition_by else batch
        seen = _Seen(watermarks or [])
        made = _stage(rows, path, [pcol] if pcol else [], cluster_by or [], finish, seen)
        if pcol and keys_may_move:
            _key_index(made, path, keys, pcol, made.count()).add(made)
        publish_whole(spark, path)
        _note_watermarks(spark, path, seen.highs())
        return "created"
    stored = path.rstrip("/") + "__batch"
    try:
        return _merge(batch, stored, path, keys, partition_by, cluster_by or [], keys_may_move, _Seen(watermarks or []), finish)
    finally:
        Files(spark, stored).delete(stored)


def _merge(batch: DataFrame, stored: str, path: str, keys: list[str], partition_by: tuple[str, str] | None, cluster_by: list[str],
           keys_may_move: bool, seen: _Seen, finish: Callable[[DataFrame], DataFrame] | None) -> str:
    spark, pcol = batch.sparkSession, None
    whole = seen.by(finish(batch) if finish else batch)
    whole.write.mode("overwrite").option("compression", "zstd").parquet(stored)
    batch = spark.read.schema(whole.schema).parquet(stored)
    if batch.isEmpty():
        return "noop"
    if partition_by:
        batch, pcol = partition_column(batch, *partition_by)
    index = _key_index(batch, path, keys, pcol) if pcol and keys_may_move else None
    if index is not None and not index.table.exists():  # a table made without one
        had = read_table(spark, path)
        index = _key_index(batch, path, keys, pcol, had.count())
        index.add(had)
    target = read_table(spark, path)
    schema = reconciled(target.schema, batch.schema)
    schema = _ordered(schema, [pcol] if pcol else [])
    target, batch = conform(target, schema), conform(batch, schema)
    batch_keys = batch.select(*keys).distinct()
    staged = staged_path(path)
    if pcol is None:
        _write(target.join(batch_keys, keys, "left_anti").unionByName(batch), staged, [], cluster_by, "overwrite")
        Files(spark, staged).write(f"{staged}/{SCHEMA_FILE}", schema.json())
        publish_whole(spark, path)
    else:
        touched = _values(batch.select(pcol))
        if index is not None:
            maybe = target.filter(_in(pcol, _values(index.partitions(batch.select(*keys)))))
            touched |= _values(maybe.join(batch_keys, keys, "left_semi").select(pcol))
            index.add(batch)
        kept = target.filter(_in(pcol, touched)).join(batch_keys, keys, "left_anti")
        _write(kept.unionByName(batch), staged, [pcol], cluster_by, "overwrite")
        names = [f"{pcol}={NULL_PARTITION if v is None else v}" for v in sorted(touched, key=str)]
        full = set(Files(spark, staged).folders(staged))
        publish_folders(spark, path, [n for n in names if n in full], [n for n in names if n not in full], schema.json())
    _note_watermarks(spark, path, seen.highs())
    return "merged"


# ---------------------------------------------------------------------------
# watermarks noted while writing
# ---------------------------------------------------------------------------
class _Seen:
    """High values that Spark counts while it writes a batch; ``wanted``: (column, by column, values of it)."""

    def __init__(self, wanted: list[tuple[str, str | None, list | None]]):
        self.wanted = [(col, by, v) for col, by, values in wanted for v in (values if by else [None])]
        self.seen = None

    def by(self, rows: DataFrame) -> DataFrame:
        if not self.wanted:
            return rows
        own = [F.when(F.col(by) == F.lit(v), F.col(col)) if by else F.col(col) for col, by, v in self.wanted]
        self.seen = Observation()
        return rows.observe(self.seen, *[F.max(x).cast("string").alias(f"m{i}") for i, x in enumerate(own)])

    def highs(self) -> list:
        """[[column, group, high value], ...]"""
        got = self.seen.get if self.seen else {}
        return [[c, v, got[f"m{i}"]] for i, (c, _, v) in enumerate(self.wanted) if got.get(f"m{i}") is not None]


def _watermark_file(path: str) -> str:
    return path.rstrip("/") + "__watermarks.json"


def _note_watermarks(spark: SparkSession, path: str, highs: list) -> None:
    """Raise the noted marks to ``highs``; they never fall."""
    if not highs:
        return
    files = Files(spark, path)
    noted = {(c, v): m for c, v, m in json.loads(files.read(_watermark_file(path)) or "[]")}
    for c, v, m in highs:
        noted[c, v] = max(m, noted.get((c, v), m))
    files.write(_watermark_file(path), json.dumps([[c, v, m] for (c, v), m in sorted(noted.items(), key=str)]))


def note_watermark(spark: SparkSession, path: str, col: str, value: dt.datetime | None) -> None:
    """Note by hand how far a table has been fed."""
    if value is not None:
        _note_watermarks(spark, path, [[col, None, str(value)]])


def watermark(spark: SparkSession, path: str, col: str, by: bool = False):
    """The highest ``col`` (a timestamp) ever merged into the
    table, per group with ``by``: {group: timestamp}. It was noted while the
    batches were written (``upsert(watermarks=...)``), so no row is read.
    None or {} before the first note."""
    noted = json.loads(Files(spark, path).read(_watermark_file(path)) or "[]")
    marks = {v: dt.datetime.fromisoformat(m) for c, v, m in noted if c == col}
    return {v: m for v, m in marks.items() if v is not None} if by else marks.get(None)


def high_watermark(target: DataFrame | None, col: str, by: str | None = None):
    """F10 / F11 / A7 from the rows themselves: max(col) of a frame (per ``by`` group).

    Returns a scalar, or {group: max} -- a bounded result (one row per source
    system). ``None`` / missing groups mean "load everything" (D3 fixed).
    """
    if target is None:
        return {} if by else None
    if by is None:
        return target.agg(F.max(col).alias("m")).first()["m"]
    return {r[by]: r["m"] for r in target.groupBy(by).agg(F.max(col).alias("m")).collect()}


# ---------------------------------------------------------------------------
# SCD2 history in two zones
# ---------------------------------------------------------------------------
ZONE, BATCH = "_zone", "_batch"


def write_snapshot(current: DataFrame, path: str, unique_key: str, updated_at: str, run_ts,
                   invalidate_hard_deletes: bool = True) -> str:
    """Bring the snapshot table at ``path`` up to ``current``; 'created' or 'merged'.

    The open versions are one folder (``_zone=open``), each run's newly closed
    ones a folder of their own below ``_zone=closed``. A run reads the open
    zone alone, writes both new folders beside the table and publishes them
    together: closed history is neither read nor written again, and a failed run loses nothing.
    """
    spark = current.sparkSession
    if table_exists(spark, path):
        rows = advance(current, read_snapshot(spark, path, open_only=True), unique_key, updated_at, run_ts, invalidate_hard_deletes)
        did = "merged"
    else:
        rows, did = first_snapshot(current, unique_key, updated_at), "created"
    is_open = F.col("dbt_valid_to").isNull()
    name = uuid.uuid4().hex
    rows = rows.withColumns({ZONE: F.when(is_open, "open").otherwise("closed"), BATCH: F.lit(name)})
    staged = staged_path(path)
    # two folders: a task writes two files at most, so no exchange deals the rows to them
    (rows.sortWithinPartitions(ZONE, BATCH).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(ZONE, BATCH).parquet(staged))
    schema = _ordered(rows.schema, [ZONE, BATCH]).json()
    files = Files(spark, staged)
    if did == "created":
        files.write(f"{staged}/{SCHEMA_FILE}", schema)
        publish_whole(spark, path)
        return did
    zones = files.folders(staged)
    publish_folders(spark, path, (["_zone=open"] if "_zone=open" in zones else []) + [f"_zone=closed/{BATCH}={name}"] * ("_zone=closed" in zones),
                    [] if "_zone=open" in zones else ["_zone=open"], schema)
    return did


def read_snapshot(spark: SparkSession, path: str, open_only: bool = False) -> DataFrame:
    """All versions, or the open ones (a partition filter)."""
    df = read_table(spark, path)
    if open_only:
        df = df.filter(F.col(ZONE) == "open")
    return df.drop(ZONE, BATCH)


__all__ = ["BucketedTable", "KeyIndex", "VERSION_COLS", "append", "high_watermark", "merge_frames", "note_watermark", "partition_column", "read_snapshot",
           "read_table", "recover", "table_exists", "upsert", "view", "watermark", "write_snapshot", "write_table"]
