"""SCD2 snapshot, timestamp strategy, closing hard deletes.

One full outer join of the open versions with the current rows (one shuffle
on the unique key); each joined pair emits up to two rows (the old version,
possibly closed, and a new version) through ``explode`` -- no self-joins, no
second pass. Closed history is not looked at.

Version columns follow public dbt snapshot behaviour: dbt_scd_id =
md5(key || '|' || updated_at), dbt_updated_at, dbt_valid_from, dbt_valid_to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import lit_ts

VERSION_COLS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _scd_id(key, updated_at):
    return F.md5(F.concat(
        F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.coalesce(updated_at.cast("string"), F.lit(""))
    ))


def first_snapshot(current: DataFrame, unique_key: str, updated_at: str) -> DataFrame:
    u = F.col(updated_at)
    return current.select(
        "*",
        _scd_id(F.col(unique_key), u).alias("dbt_scd_id"),
        u.alias("dbt_updated_at"),
        u.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )


def advance(
    current: DataFrame,
    open_versions: DataFrame,
    unique_key: str,
    updated_at: str,
    run_ts,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """What this run makes of the open versions: those that stay open, those
    it closes (``dbt_valid_to`` set) and the new ones. Columns that only one side has are NULL on the other."""
    cols = [c for c in open_versions.columns if c not in VERSION_COLS]
    cols += [c for c in current.columns if c not in cols]
    old = open_versions
    for c in cols:
        if c not in old.columns:
            old = old.withColumn(c, F.lit(None).cast(current.schema[c].dataType))
        if c not in current.columns:
            current = current.withColumn(c, F.lit(None).cast(old.schema[c].dataType))
    all_cols = cols + VERSION_COLS
    o = old.select(F.col(unique_key).alias("_k"), F.struct(*[F.col(c) for c in all_cols]).alias("o"))
    n = current.select(F.col(unique_key).alias("_k"), F.struct(*[F.col(c) for c in cols]).alias("n"))
    j = o.join(n, "_k", "full_outer")

    has_o, has_n = F.col("o").isNotNull(), F.col("n").isNotNull()
    new_u = F.col(f"n.{updated_at}")
    changed = has_o & has_n & (new_u > F.col("o.dbt_updated_at"))
    deleted = has_o & ~has_n
    close_at = F.when(changed, new_u)
    if invalidate_hard_deletes:
        close_at = close_at.when(deleted, lit_ts(run_ts))
    old_row = F.when(has_o, F.col("o").withField("dbt_valid_to", F.coalesce(close_at, F.col("o.dbt_valid_to"))))
    new_row = F.when(
        (has_n & ~has_o) | changed,
        F.struct(
            *[F.col(f"n.{c}").alias(c) for c in cols],
            _scd_id(F.col(f"n.{unique_key}"), new_u).alias("dbt_scd_id"),
            new_u.alias("dbt_updated_at"),
            new_u.alias("dbt_valid_from"),
            F.lit(None).cast("timestamp").alias("dbt_valid_to"),
        ),
    )
    rows = j.select(F.explode(F.array(old_row, new_row)).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    return rows.select(*all_cols)


def snapshot(
    current: DataFrame,
    existing: DataFrame | None,
    unique_key: str,
    updated_at: str,
    run_ts,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The full snapshot table after this run, as a frame; ``sinks.write_snapshot``
    keeps the table itself without touching closed versions."""
    if existing is None:
        return first_snapshot(current, unique_key, updated_at)
    history = existing.filter(F.col("dbt_valid_to").isNotNull())
    rows = advance(current, existing.filter(F.col("dbt_valid_to").isNull()), unique_key, updated_at, run_ts, invalidate_hard_deletes)
    return history.unionByName(rows, allowMissingColumns=True).select(*rows.columns)
