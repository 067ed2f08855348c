"""Insert-only hub / link / satellite loaders.

Each loader takes the batch rows and, optionally, the current target table
and returns only the rows to append (J8 / J9). A target kept as a
``sinks.BucketedTable`` on the compared columns is read without a shuffle.
Appending is idempotent: a re-run after a failure computes the same
anti-join against what was already written.

Keys are ``surrogate_key`` hashes. Per-batch de-duplication keeps the
earliest load_date per key (the reference's DISTINCT includes load_date, so
one key could be inserted several times -- fixed, see README).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import surrogate_key
from ledgerlake.operators.joins import anti_join_target


def _earliest_per_key(df: DataFrame, key: str, load_date: str = "load_date") -> DataFrame:
    """One row per key with its earliest load_date.

    The other columns (business key or hub keys, record source) are inputs of
    the key's hash, so they are constant per key and can be grouping columns:
    the aggregate is then ``min`` of a timestamp, a hash aggregate with
    map-side combining (a ``min`` over a struct of strings would force a
    sort-based aggregate over the whole batch).
    """
    group = [c for c in df.columns if c != load_date]
    return df.groupBy(*group).agg(F.min(load_date).alias(load_date)).select(*df.columns)


def _dealt(df: DataFrame, deal_once: bool, *key: Column) -> DataFrame:
    """``deal_once``: the rows dealt by a key that is made again after it: the
    key is not shuffled, and neither grouping by it nor joining on it deals
    them again. For keys of few rows each, as without it rows are combined
    before the shuffle, and for a target that is not bucketed, as a batch that
    is dealt already does not follow the buckets."""
    return df.repartition(*key) if deal_once else df


def hub(sources: list[tuple[DataFrame, str, str | Column, str]], key_name: str, bk_name: str,
        target: DataFrame | None = None, deal_once: bool = False) -> DataFrame:
    """Hub rows to insert.

    ``sources``: (frame, business-key column, record_source (literal or
    column name prefixed with '@'), load_date column). ``deal_once``: see ``_dealt``.
    """
    parts = []
    for df, bk, rs, ld in sources:
        rs_col = F.col(rs[1:]) if isinstance(rs, str) and rs.startswith("@") else F.lit(rs)
        parts.append(df.select(
            F.col(bk).alias(bk_name), rs_col.alias("record_source"), F.col(ld).alias("load_date")
        ))
    u = _dealt(reduce(DataFrame.unionByName, parts), deal_once, surrogate_key(bk_name, "record_source"))
    keyed = u.select(surrogate_key(bk_name, "record_source").alias(key_name), bk_name, "record_source", "load_date")
    new = _earliest_per_key(keyed, key_name)
    return anti_join_target(new, target, [key_name]).select(key_name, bk_name, "record_source", "load_date")


def link(df: DataFrame, key_name: str, hub_keys: dict[str, Column], record_source: Column, load_date: Column,
         target: DataFrame | None = None, deal_once: bool = False) -> DataFrame:
    """Link rows to insert: one per distinct pair of hub keys. ``deal_once``: see ``_dealt``."""
    names = list(hub_keys)
    rel = _dealt(df, deal_once, surrogate_key(*hub_keys.values())).select(*[c.alias(n) for n, c in hub_keys.items()], record_source.alias("record_source"),
                    load_date.alias("load_date"))
    keyed = rel.select(surrogate_key(*names).alias(key_name), *names, "record_source", "load_date")
    new = _earliest_per_key(keyed, key_name)
    return anti_join_target(new, target, [key_name]).select(key_name, *names, "record_source", "load_date")


def satellite(df: DataFrame, key_name: str, hub_key: Column, hub_key_name: str, hash_cols: list[str],
              payload: dict[str, Column], record_source: Column, load_date: Column,
              target: DataFrame | None = None, compare: str = "any", deal_once: bool = False) -> DataFrame:
    """Satellite rows to insert. ``deal_once``: the batch is dealt by (hub key,
    hash_diff) before they are made, as by ``_dealt``.

    ``compare='any'`` (reference behaviour): skip a row when its (hub key,
    hash_diff) pair exists anywhere in the target, so A -> B -> A does not
    record the return to A. ``compare='latest'``: compare with the latest
    version of the key only.
    """
    hash_diff = surrogate_key(*[df[c] if c in df.columns else F.col(c) for c in hash_cols])
    s = _dealt(df, deal_once and target is not None, hub_key, hash_diff).select(
        hub_key.alias(hub_key_name),
        *[c.alias(n) for n, c in payload.items()],
        record_source.alias("record_source"),
        load_date.alias("load_date"),
        hash_diff.alias("hash_diff"),
    )
    out = s.select(
        surrogate_key(hub_key_name, "load_date").alias(key_name), hub_key_name, "hash_diff",
        *payload.keys(), "record_source", "load_date",
    )
    if target is None:
        return out
    if compare == "any":
        return out.join(target.select(hub_key_name, "hash_diff"), [hub_key_name, "hash_diff"], "left_anti")
    if compare == "latest":
        # ties on load_date are broken by the hash itself, so a retried task picks the same row
        latest = target.groupBy(hub_key_name).agg(
            F.max_by("hash_diff", F.struct("load_date", "hash_diff")).alias("hash_diff"))
        return out.join(latest, [hub_key_name, "hash_diff"], "left_anti")
    raise ValueError(compare)
