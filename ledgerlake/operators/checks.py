"""Data-quality checks Q1-Q12 and the run tally G5.

Each check returns its *failing rows* as a DataFrame (empty = pass), like a
test query. ``run_checks`` evaluates a declared suite and returns one row per
check ``(model, check, column, status, failures)``; all column-level checks
of one model are folded into a single aggregate, so a model is scanned once
for them (plus one grouped aggregate per uniqueness check).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ledgerlake.functions import hour_diff, lit_ts, safe_divide_null


# ---------------------------------------------------------------------------
# Single checks (failing rows)
# ---------------------------------------------------------------------------
def not_null(df: DataFrame, col: str) -> DataFrame:  # Q1
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:  # Q2 (NULLs ignored)
    return df.filter(F.col(col).isNotNull()).groupBy(col).count().filter(F.col("count") > 1)


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:  # Q3 (NULL passes)
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str, where: str | None = None):  # Q4 / J11
    child = df.filter(where) if where else df
    child = child.filter(F.col(col).isNotNull())
    return child.join(parent.select(F.col(field).alias("__p")).distinct(), F.col(col) == F.col("__p"), "left_anti")


def values_between(df: DataFrame, col: str, min_value=None, max_value=None, where: str | None = None):  # Q5
    base = df.filter(where) if where else df
    return base.filter(_outside(F.col(col), min_value, max_value))


def match_regex(df: DataFrame, col: str, regex: str, where: str | None = None):  # Q6
    base = df.filter(where) if where else df
    return base.filter(~F.col(col).rlike(regex))


def row_count_between(df: DataFrame, min_value: int | None = None, max_value: int | None = None):  # Q7
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    return n.filter(_outside(F.col("row_count"), min_value, max_value))


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:  # Q8
    return df.groupBy(*cols).count().filter(F.col("count") > 1)


def balanced_debits_credits(df: DataFrame, debit: str, credit: str, group_by: str, tolerance: float = 0.01):  # Q10
    t = df.groupBy(group_by).agg(F.sum(debit).alias("total_debits"), F.sum(credit).alias("total_credits"))
    return t.filter(F.abs(F.col("total_debits") - F.col("total_credits")) > F.lit(tolerance))


def orphan_rate(fct: DataFrame, threshold: float = 0.05) -> DataFrame:  # Q11 (stats + verdict, one row)
    s = fct.filter(F.col("entity_type") == "customer").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("customer_key").isNull()).alias("orphan_rows"),
    )
    rate = safe_divide_null(F.col("orphan_rows").cast("double"), F.col("total_rows").cast("double"))
    return s.select("*", F.round(rate, 6).alias("orphan_rate"), F.coalesce(rate > threshold, F.lit(False)).alias("is_failing"))


def revenue_reconciliation(revenue: DataFrame, as_of, since_year: int = 2023, threshold: float = 0.10,
                           completed_only: bool = True) -> DataFrame:
    """Q12: completed quarters since ``since_year`` whose recognized revenue is
    more than ``threshold`` off the booked revenue (full outer join, J6).
    ``threshold < 0`` and ``completed_only=False`` return the whole comparison."""
    def total(stage, name):
        return (revenue.filter((F.col("revenue_stage") == stage) & (F.col("revenue_year") >= since_year))
                .groupBy("revenue_year", "revenue_quarter").agg(F.sum("revenue_amount").alias(name)))

    r, b = total("recognized", "total_recognized"), total("booked", "total_booked")
    j = r.join(b, ["revenue_year", "revenue_quarter"], "full_outer")
    zero = F.lit(0).cast("decimal(28,9)")
    rec = F.coalesce("total_recognized", zero).cast("decimal(28,9)")
    bkd = F.coalesce("total_booked", zero).cast("decimal(28,9)")
    comp = j.select(
        F.col("revenue_year").alias("year"), F.col("revenue_quarter").alias("quarter"),
        rec.alias("recognized"), bkd.alias("booked"), F.abs(rec - bkd).cast("decimal(28,9)").alias("variance"),
    )
    d = F.to_date(F.lit(str(as_of)))
    # string comparison of year||quarter, exactly as declared
    this_q = F.concat(F.year(d).cast("string"), F.quarter(d).cast("string"))
    period = F.concat(F.col("year").cast("string"), F.col("quarter").cast("string"))
    if threshold < 0 and not completed_only:
        return comp
    ratio = F.col("variance").cast("double") / F.col("booked").cast("double")
    cond = (F.col("booked") > 0) & (ratio > threshold)
    if completed_only:
        cond = cond & (period < this_q)
    return comp.filter(cond)


def source_freshness_check(loaded: DataFrame, now, warn_after_h: int, error_after_h: int) -> DataFrame:
    """Q9: one row per source: hours since max(_loaded_at) and pass/warn/error."""
    m = loaded.groupBy("source").agg(F.max("_loaded_at").alias("max_loaded_at"))
    h = hour_diff(lit_ts(now), F.col("max_loaded_at"))
    return m.select(
        "source", "max_loaded_at", h.alias("hours_since_load"),
        F.when(h.isNull() | (h > error_after_h), "error").when(h > warn_after_h, "warn").otherwise("pass").alias("status"),
    )


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


# ---------------------------------------------------------------------------
# Suites
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    kind: str  # not_null | unique | accepted_values | between | regex | row_count | relationships | unique_combination
    column: str | None = None
    args: dict = field(default_factory=dict)
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})" if self.column else self.kind


RESULT_SCHEMA = StructType([
    StructField("model", StringType()), StructField("check", StringType()), StructField("column", StringType()),
    StructField("status", StringType()), StructField("failures", LongType()),
])


def _violation(c: Check) -> Column | None:
    """Row-level violation predicate for checks foldable into one aggregate."""
    x = F.col(c.column) if c.column else None
    where = F.expr(c.args["where"]) if c.args.get("where") else F.lit(True)
    if c.kind == "not_null":
        return x.isNull()
    if c.kind == "accepted_values":
        return x.isNotNull() & ~x.isin(*c.args["values"])
    if c.kind == "between":
        return F.coalesce(where & _outside(x, c.args.get("min"), c.args.get("max")), F.lit(False))
    if c.kind == "regex":
        return F.coalesce(where & ~x.rlike(c.args["regex"]), F.lit(False))
    return None


def run_model_checks(spark: SparkSession, model: str, df: DataFrame, checks: list[Check],
                     parents: dict[str, DataFrame] | None = None) -> DataFrame:
    foldable = [c for c in checks if _violation(c) is not None or c.kind == "row_count"]
    rows: list[DataFrame] = []
    if foldable:
        aggs = []
        for i, c in enumerate(foldable):
            if c.kind == "row_count":
                aggs.append(F.count(F.lit(1)).alias(f"c{i}"))
            else:
                aggs.append(F.count_if(_violation(c)).alias(f"c{i}"))
        fails = [
            F.when(_outside(F.col(f"c{i}"), c.args.get("min"), c.args.get("max")), 1).otherwise(0).alias(f"c{i}")
            if c.kind == "row_count" else F.col(f"c{i}")
            for i, c in enumerate(foldable)
        ]
        rows.append(_stacked(model, df.agg(*aggs).select(*fails), foldable, "c"))
    uniq = [c for c in checks if c.kind in ("unique", "unique_combination")]
    if len(uniq) >= 2:
        rows.append(_uniqueness_counts(model, df, uniq))
    else:
        uniq = []
    for c in checks:
        if c in foldable or c in uniq:
            continue
        if c.kind == "unique":
            bad = unique(df, c.column)
        elif c.kind == "unique_combination":
            bad = unique_combination(df, c.args["columns"])
        elif c.kind == "relationships":
            bad = relationships(df, c.column, (parents or {})[c.args["to"]], c.args["field"], c.args.get("where"))
        else:
            raise ValueError(c.kind)
        rows.append(bad.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
            F.lit(model).alias("model"), F.lit(c.kind).alias("check"), F.lit(c.column).cast("string").alias("column"),
            "failures", F.lit(c.severity).alias("_sev")))
    u = reduce(DataFrame.unionByName, rows)
    status = F.when(F.col("failures") == 0, "pass").when(F.col("_sev") == "warn", "warn").otherwise("fail")
    return u.select("model", "check", "column", status.alias("status"), "failures")


def _uniqueness_counts(model: str, df: DataFrame, uniq: list[Check]) -> DataFrame:
    """All uniqueness checks of one model in one shuffle.

    Each row emits one (check id, value) pair per check (composite keys are
    packed as a struct serialized to JSON; single columns skip NULLs, as Q2
    ignores them); one aggregate counts the values seen more than once per
    check, and ``stack`` turns the counts into one result row per check.
    Partial aggregation combines duplicates map-side, so a hot value is
    pre-aggregated before the shuffle.
    """
    pairs = []
    for i, c in enumerate(uniq):
        if c.kind == "unique":
            v = F.col(c.column).cast("string")
            pairs.append(F.when(F.col(c.column).isNotNull(), F.struct(F.lit(i).alias("i"), v.alias("v"))))
        else:
            v = F.to_json(F.struct(*[F.col(x) for x in c.args["columns"]]))
            pairs.append(F.struct(F.lit(i).alias("i"), v.alias("v")))
    exploded = df.select(F.explode(F.array(*pairs)).alias("p")).filter(F.col("p").isNotNull()).select("p.i", "p.v")
    dup = exploded.groupBy("i", "v").count().filter(F.col("count") > 1)
    counts = dup.agg(*[F.count_if(F.col("i") == i).alias(f"u{i}") for i in range(len(uniq))])
    return _stacked(model, counts, uniq, "u")


def _stacked(model: str, counts: DataFrame, checks: list[Check], prefix: str) -> DataFrame:
    """The single row of ``counts`` as one result row per check; the scan below it stays one."""
    items = ", ".join(
        f"'{c.kind}', {repr(c.column) if c.column else 'CAST(NULL AS STRING)'}, '{c.severity}', CAST({prefix}{i} AS BIGINT)"
        for i, c in enumerate(checks))
    out = counts.selectExpr(f"stack({len(checks)}, {items}) as (check, column, _sev, failures)")
    return out.select(F.lit(model).alias("model"), "check", "column", "failures", "_sev")


def tally(results: DataFrame) -> DataFrame:
    """Counts of pass / fail / warn / error; any other status is a skip."""
    st = F.col("status")
    return results.agg(
        F.count_if(st == "pass").alias("passed"),
        F.count_if(st == "fail").alias("failed"),
        F.count_if(st == "warn").alias("warnings"),
        F.count_if(st == "error").alias("errors"),
        F.count_if(~st.isin("pass", "fail", "warn", "error") | st.isNull()).alias("skipped"),
    )
