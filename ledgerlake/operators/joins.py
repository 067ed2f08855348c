"""Join building blocks.

* ``left_join_spread`` -- left outer equi-join where rows that can never match
  (NULL key, or a key value outside the lookup's domain) are given a
  deterministic, row-specific key instead of sharing the NULL partition. With
  a third of the rows unmatchable (e.g. every Plaid row in the customer
  lookup) this keeps the sort-merge join balanced; AQE's skew-join split
  handles hot *matching* keys.
* ``left_join_matchable`` -- the same join for a left side that is cheap to
  read twice: rows that can never match pass beside the join and are not
  shuffled at all.
* ``id_lookup`` (J10) -- one-pass unpivot of several id columns into a
  ``(owner, source_id, system)`` lookup.
* ``not_in`` (J7) and ``anti_join_target`` (J8/J9) -- NULL-safe anti-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# key prefix that real string ids never start with
_SPREAD_PREFIX = "\u0001"


def left_join_spread(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    spread_col: str,
    matchable: Column | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON left.a = right.b AND ...`` (string keys).

    ``pairs`` are (left column, right column). Rows with a NULL left key, or
    where ``matchable`` is false, cannot match; their first key is replaced by
    a prefix plus ``spread_col`` (deterministic, so a retried map task sends
    every row to the same reducer) and they come back with NULL right columns.
    """
    ok = F.lit(True)
    for lc, _ in pairs:
        ok = ok & F.col(lc).isNotNull()
    if matchable is not None:
        ok = ok & F.coalesce(matchable, F.lit(False))
    jks = []
    l2 = left
    for i, (lc, _) in enumerate(pairs):
        name = f"__jk{i}"
        if i == 0:
            expr = F.when(ok, F.col(lc).cast("string")).otherwise(
                F.concat(F.lit(_SPREAD_PREFIX), F.col(spread_col).cast("string"))
            )
        else:
            expr = F.when(ok, F.col(lc).cast("string"))
        l2 = l2.withColumn(name, expr)
        jks.append(name)
    r2 = right
    rks = []
    for i, (_, rc) in enumerate(pairs):
        name = f"__rk{i}"
        r2 = r2.withColumn(name, F.col(rc).cast("string"))
        rks.append(name)
    cond = [l2[a] == r2[b] for a, b in zip(jks, rks)]
    out = l2.join(r2, cond, "left")
    return out.drop(*jks, *rks)


def left_join_matchable(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    matchable: Column | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON left.a = right.b AND ...`` (string keys), rows as from ``left_join_spread``.

    ``left`` is read twice, so it must be a table or a row-local projection of one."""
    ok = F.lit(True) if matchable is None else F.coalesce(matchable, F.lit(False))
    for lc, _ in pairs:
        ok = ok & F.col(lc).isNotNull()
    l2 = left.filter(ok)
    cond = [l2[lc].cast("string") == right[rc].cast("string") for lc, rc in pairs]
    joined = l2.join(right, cond, "left")
    rest = left.filter(~ok).withColumns({f.name: F.lit(None).cast(f.dataType) for f in right.schema})
    return joined.unionByName(rest)


def id_lookup(df: DataFrame, owner: str, id_cols: dict[str, str]) -> DataFrame:
    """Unpivot ``{system: id column}`` into (owner, source_id, sys), no NULL ids."""
    n = len(id_cols)
    args = ", ".join(f"'{sys}', `{c}`" for sys, c in id_cols.items())
    return (
        df.select(owner, *id_cols.values())
        .selectExpr(f"`{owner}`", f"stack({n}, {args}) as (sys, source_id)")
        .filter(F.col("source_id").isNotNull())
        .select(owner, "source_id", "sys")
    )


def not_in(left: DataFrame, left_col: str, sub: DataFrame, sub_col: str) -> DataFrame:
    """``left_col NOT IN (SELECT sub_col FROM sub WHERE sub_col IS NOT NULL)``.

    SQL NOT IN drops a NULL left key; a plain anti-join would keep it, so the
    NULL filter is explicit. Written as a left_anti join (sort-merge or
    AQE-broadcast) instead of the null-aware broadcast anti join that NOT IN
    plans to, which would have to broadcast the whole subquery.
    """
    keys = sub.filter(F.col(sub_col).isNotNull()).select(F.col(sub_col).alias("__k")).distinct()
    return left.filter(F.col(left_col).isNotNull()).join(
        keys, F.col(left_col) == F.col("__k"), "left_anti"
    )


def anti_join_target(batch: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` whose key tuple is not yet in ``target``."""
    if target is None:
        return batch
    return batch.join(target.select(*keys), keys, "left_anti")
