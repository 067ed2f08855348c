"""Data-quality marts M33-M36."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import (
    BASE,
    classify_amount,
    count_present,
    hour_diff,
    lit_date,
    lit_ts,
    pct_variance,
    safe_divide,
)
from ledgerlake.operators.windows import rolling_zscores
from ledgerlake.params import DEFAULT, RunParams

AMT = BASE


def since(utx: DataFrame, p: RunParams, days: int) -> DataFrame:
    """F8: rows of the last ``days`` days. On a month table the month is bounded
    too, by a literal, so the scan opens those months' folders only."""
    start = p.as_of - dt.timedelta(days=days)
    out = utx.filter(F.col("transaction_date") >= F.lit(start))
    month = "transaction_date_month"
    return out.filter(F.col(month) >= f"{start:%Y-%m}") if month in utx.columns else out


# ---------------------------------------------------------------------------
# M33 cross-source reconciliation
# ---------------------------------------------------------------------------
def daily_totals_by_source(utx: DataFrame, p: RunParams = DEFAULT, days: int = 90) -> DataFrame:
    """A9 step 1: per (date, source, category) counts, totals, debits, credits."""
    a = F.col("amount")
    zero = F.lit(0).cast(AMT)
    side = classify_amount(a)  # G3: debit (> 0) / credit (< 0) / zero
    return (
        since(utx, p, days)
        .groupBy("transaction_date", "source_system", "transaction_category")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum(a).cast(AMT).alias("total_amount"),
            F.sum(F.when(side == "debit", a).otherwise(zero)).cast(AMT).alias("total_debits"),
            F.sum(F.when(side == "credit", F.abs(a)).otherwise(zero)).cast(AMT).alias("total_credits"),
        )
    )


RECON_BANDS = [("match", 1), ("minor_variance", 100), ("notable_variance", 1000)]


def reconciliation_status(abs_var):
    s = F.when(abs_var < RECON_BANDS[0][1], RECON_BANDS[0][0])
    for name, hi in RECON_BANDS[1:]:
        s = s.when(abs_var < hi, name)
    return s.otherwise("critical_variance")


def cross_source_reconciliation(utx: DataFrame, p: RunParams = DEFAULT, keep_matches: bool = False) -> DataFrame:
    zero = F.lit(0).cast(AMT)
    daily = daily_totals_by_source(utx, p).filter(
        F.col("transaction_category").isin("cash_receipt", "cash_disbursement")
    )
    src, tot = F.col("source_system"), F.col("total_amount")
    avb = daily.groupBy("transaction_date", "transaction_category").agg(
        F.sum(F.when(src.isin("quickbooks", "netsuite"), tot).otherwise(zero)).cast(AMT).alias("accounting_total"),
        F.sum(F.when(src == "plaid", tot).otherwise(zero)).cast(AMT).alias("bank_total"),
        F.sum(F.when(src == "stripe", tot).otherwise(zero)).cast(AMT).alias("stripe_total"),
    )
    var = (F.col("accounting_total") - F.col("bank_total")).cast(AMT)
    out = avb.select(
        "transaction_date", "transaction_category", "accounting_total", "bank_total", "stripe_total",
        var.alias("accounting_bank_variance"),
        F.abs(var).alias("absolute_variance"),
        pct_variance("accounting_total", "bank_total").alias("variance_pct"),
        reconciliation_status(F.abs(var)).alias("reconciliation_status"),
        lit_ts(p.run_ts).alias("_checked_at"),
    )
    if not keep_matches:
        out = out.filter(F.col("reconciliation_status") != "match")
    return out.orderBy(F.col("transaction_date").desc(), F.col("absolute_variance").desc())


# ---------------------------------------------------------------------------
# M34 golden record completeness
# ---------------------------------------------------------------------------
COMPLETENESS_FIELDS = [
    ("company_name", "has_company_name"), ("email", "has_email"), ("phone", "has_phone"),
    ("billing_address", "has_address"), ("billing_city", "has_city"), ("billing_state", "has_state"),
    ("billing_postal_code", "has_postal_code"), ("billing_country", "has_country"),
    ("industry", "has_industry"), ("customer_segment", "has_segment"),
]
GRADES = [("excellent", 9), ("good", 7), ("fair", 5)]


def golden_record_completeness(dim: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    n = count_present(*[c for c, _ in COMPLETENESS_FIELDS])
    total = len(COMPLETENESS_FIELDS)
    scored = dim.select(
        "customer_key", "company_name", "customer_tier", "primary_source",
        n.alias("fields_populated"),
        F.lit(total).alias("total_fields"),
        *[F.col(c).isNotNull().alias(flag) for c, flag in COMPLETENESS_FIELDS],
        F.col("is_multi_source_match").alias("has_cross_system_match"),
    )
    fp = F.col("fields_populated")
    grade = F.when(fp >= GRADES[0][1], GRADES[0][0])
    for g, lo in GRADES[1:]:
        grade = grade.when(fp >= lo, g)
    return scored.select(
        "*",
        F.round(safe_divide(fp, F.col("total_fields")) * 100, 1).alias("completeness_pct"),  # G2
        grade.otherwise("poor").alias("completeness_grade"),
        lit_ts(p.run_ts).alias("_checked_at"),
    ).orderBy(F.col("completeness_pct").asc())


# ---------------------------------------------------------------------------
# M35 source freshness
# ---------------------------------------------------------------------------
# Freshness SLA hours per source; sources not listed use 12 for
# the healthy/warning thresholds and have a NULL sla_hours column
SLA_HOURS = {"stripe": 6, "plaid": 24, "quickbooks": 12, "netsuite": 12, "salesforce": 12}
DEFAULT_SLA = 12


def source_freshness(utx: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    as_of = lit_date(p.as_of)
    d = F.col("transaction_date")
    fc = utx.groupBy("source_system").agg(
        F.max("_unified_at").alias("last_record_at"),
        F.max(d).alias("most_recent_transaction_date"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(d >= F.date_sub(as_of, 7)).alias("records_last_7_days"),
        F.count_if(d >= F.date_sub(as_of, 1)).alias("records_last_24_hours"),
    )
    src = F.col("source_system")
    sla = None
    for s, h in SLA_HOURS.items():
        sla = (F.when(src == s, h) if sla is None else sla.when(src == s, h))
    thr = F.when(src == "stripe", 6).when(src == "plaid", 24).otherwise(DEFAULT_SLA)
    hrs = hour_diff(lit_ts(p.run_ts), F.col("last_record_at"))
    status = F.when(hrs <= thr, "healthy").when(hrs <= thr * 2, "warning").otherwise("critical")
    out = fc.select(
        "source_system", "last_record_at", "most_recent_transaction_date", "total_records",
        "records_last_7_days", "records_last_24_hours",
        hrs.alias("hours_since_last_load"),
        sla.alias("sla_hours"),
        status.alias("freshness_status"),
        lit_ts(p.run_ts).alias("_checked_at"),
    )
    rank = F.when(F.col("freshness_status") == "critical", 1).when(F.col("freshness_status") == "warning", 2).otherwise(3)
    return out.orderBy(rank)


# ---------------------------------------------------------------------------
# M36 transaction anomalies
# ---------------------------------------------------------------------------
def daily_stats(utx: DataFrame, p: RunParams = DEFAULT, days: int = 120) -> DataFrame:
    """A1: per (date, source) count / sum / avg / max -- pre-aggregated so the
    window below runs over one row per day and source, never over raw rows."""
    a = F.col("amount")
    return (
        since(utx, p, days)
        .groupBy("transaction_date", "source_system")
        .agg(
            F.count(F.lit(1)).alias("daily_count"),
            F.sum(a).cast(AMT).alias("daily_total"),
            F.avg(a.cast("double")).alias("daily_avg_amount"),
            F.max(a).alias("daily_max_amount"),
        )
    )


def transaction_anomalies(utx: DataFrame, p: RunParams = DEFAULT, flagged_only: bool = True) -> DataFrame:
    ds = daily_stats(utx, p)
    ds = ds.withColumn("_total_d", F.col("daily_total").cast("double"))
    r = rolling_zscores(ds, "source_system", "transaction_date", {"count": "daily_count", "total": "_total_d"},
                        preceding=30)
    out = r.filter(F.col("transaction_date") >= F.date_sub(lit_date(p.as_of), 90)).select(
        "transaction_date", "source_system", "daily_count", "daily_total",
        F.round("rolling_avg_count", 6).alias("rolling_avg_count"),
        F.round("rolling_stddev_count", 6).alias("rolling_stddev_count"),
        F.round("rolling_avg_total", 6).alias("rolling_avg_total"),
        F.round("rolling_stddev_total", 6).alias("rolling_stddev_total"),
        F.col("count_z_score"),
        F.col("total_z_score").alias("amount_z_score"),
        F.col("is_count_anomaly"),
        F.col("is_total_anomaly").alias("is_amount_anomaly"),
        lit_ts(p.run_ts).alias("_checked_at"),
    )
    if flagged_only:
        out = out.filter(F.col("is_count_anomaly") | F.col("is_amount_anomaly"))
    return out.orderBy(F.col("transaction_date").desc())
