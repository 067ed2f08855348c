"""Hand-made frames for the edge rows the driver tables do not produce."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.params import RunParams
from ledgerlake.plans import marts, quality

P = RunParams()
AS_OF = P.as_of


def test_aging_buckets_at_every_boundary(spark):
    rows = []
    for i, days in enumerate([-5, 0, 1, 30, 31, 60, 61, 90, 91]):
        rows.append((f"i{i}", "c", Decimal("10"), Decimal("10"), AS_OF - dt.timedelta(days=days)))
    rows.append(("paid_late", "c", Decimal("10"), Decimal("0"), AS_OF - dt.timedelta(days=400)))
    rows.append(("no_due", "c", Decimal("10"), Decimal("10"), None))
    inv = spark.createDataFrame(rows, "invoice_id string, customer_id string, total_amount decimal(18,4), "
                                      "balance_due decimal(18,4), due_date date")
    inv = inv.select("*", F.lit("n").alias("invoice_number"), F.lit(None).cast("date").alias("invoice_date"),
                     F.lit("open").alias("payment_status"), F.lit("USD").alias("currency_code"),
                     F.lit("quickbooks").alias("source_system"))
    golden = spark.createDataFrame([("g1", "c")], "customer_golden_id string, quickbooks_customer_id string")
    got = {r.invoice_id: (r.aging_bucket, r.aging_bucket_sort, r.days_past_due)
           for r in marts.fct_accounts_receivable(inv, golden, P).collect()}
    assert got["i0"] == ("Current", 1, -5)
    assert got["i1"] == ("Current", 1, 0)        # due today is not past due
    assert got["i2"][:2] == ("1-30 Days", 2)
    assert got["i3"][:2] == ("1-30 Days", 2)
    assert got["i4"][:2] == ("31-60 Days", 3)
    assert got["i5"][:2] == ("31-60 Days", 3)
    assert got["i6"][:2] == ("61-90 Days", 4)
    assert got["i7"][:2] == ("61-90 Days", 4)
    assert got["i8"][:2] == ("90+ Days", 5)
    assert got["paid_late"][:2] == ("Paid", 0)
    assert got["no_due"][:2] == ("90+ Days", 5)  # NULL due date falls through


def test_customer_tiers(spark):
    df = spark.createDataFrame([(Decimal(v),) if v is not None else (None,) for v in
                                ["100000", "99999.99", "25000", "5000", "0.01", "0", None]], "r decimal(28,9)")
    got = [r.t for r in df.select(marts.customer_tier(F.coalesce("r", F.lit(0))).alias("t")).collect()]
    assert got == ["Enterprise", "Mid-Market", "Mid-Market", "SMB", "Starter", "Prospect", "Prospect"]


def _utx(spark, rows):
    return spark.createDataFrame(rows, "transaction_date date, source_system string, transaction_category string, "
                                       "amount decimal(28,9)").withColumn("_unified_at", F.lit(P.run_ts))


def test_reconciliation_bands_and_zero_bank(spark):
    d = [AS_OF - dt.timedelta(days=i) for i in range(6)]
    rows = [
        (d[0], "quickbooks", "cash_receipt", Decimal("100.50")), (d[0], "plaid", "cash_receipt", Decimal("100")),
        (d[1], "netsuite", "cash_receipt", Decimal("150")), (d[1], "plaid", "cash_receipt", Decimal("100")),
        (d[2], "quickbooks", "cash_receipt", Decimal("600")), (d[2], "plaid", "cash_receipt", Decimal("100")),
        (d[3], "quickbooks", "cash_receipt", Decimal("5000")),                      # bank total 0
        (d[4], "stripe", "cash_receipt", Decimal("7")),                             # both totals 0
        (d[5], "plaid", "cash_disbursement", Decimal("-2000")),
    ]
    out = quality.cross_source_reconciliation(_utx(spark, rows), P, keep_matches=True).collect()
    got = {r.transaction_date: (r.reconciliation_status, r.variance_pct) for r in out}
    assert got[d[0]] == ("match", 0.5)
    assert got[d[1]] == ("minor_variance", 50.0)
    assert got[d[2]] == ("notable_variance", 500.0)
    assert got[d[3]] == ("critical_variance", 100.0)
    assert got[d[4]] == ("match", 0.0)
    assert got[d[5]] == ("critical_variance", 100.0)
    dropped = quality.cross_source_reconciliation(_utx(spark, rows), P).collect()
    assert {r.reconciliation_status for r in dropped} == {"minor_variance", "notable_variance", "critical_variance"}


def test_anomaly_frame_counts_rows_and_guards_stddev(spark):
    base = AS_OF - dt.timedelta(days=40)
    rows = []
    for i in range(35):  # constant series, then a spike on the last day
        n = 50 if i == 34 else 5
        for _ in range(n):
            rows.append((base + dt.timedelta(days=i), "stripe", "cash_receipt", Decimal("1")))
    rows.append((AS_OF - dt.timedelta(days=3), "plaid", "cash_receipt", Decimal("1")))  # single day: no history
    out = quality.transaction_anomalies(_utx(spark, rows), P, flagged_only=False).collect()
    by = {(r.source_system, r.transaction_date): r for r in out}
    spike = by[("stripe", base + dt.timedelta(days=34))]
    # all 30 prior days are 5 -> stddev 0 -> guarded: z 0 and no flag
    assert spike.rolling_stddev_count == 0.0 and spike.count_z_score == 0.0 and not spike.is_count_anomaly
    lone = by[("plaid", AS_OF - dt.timedelta(days=3))]
    assert lone.rolling_stddev_count is None and lone.count_z_score == 0.0 and not lone.is_count_anomaly


def test_anomaly_flags_a_spike_after_varied_history(spark):
    base = AS_OF - dt.timedelta(days=40)
    rows = []
    for i in range(35):
        n = 60 if i == 34 else (4 + i % 3)
        rows += [(base + dt.timedelta(days=i), "stripe", "cash_receipt", Decimal("1"))] * n
    out = quality.transaction_anomalies(_utx(spark, rows), P).collect()
    spike = [r for r in out if r.transaction_date == base + dt.timedelta(days=34)]
    assert spike and spike[0].is_count_anomaly and spike[0].count_z_score > 2
    # the 30-row frame is full from day 30 on; only the spike is flagged there
    assert [r.transaction_date for r in out if r.transaction_date >= base + dt.timedelta(days=30)] == [
        base + dt.timedelta(days=34)]
    # output is newest first
    assert [r.transaction_date for r in out] == sorted((r.transaction_date for r in out), reverse=True)


def test_freshness_status_by_sla(spark):
    run = P.run_ts
    rows = [
        ("stripe", run - dt.timedelta(hours=5)), ("plaid", run - dt.timedelta(hours=30)),
        ("quickbooks", run - dt.timedelta(hours=25)), ("other", run - dt.timedelta(hours=13)),
    ]
    df = spark.createDataFrame(rows, "source_system string, _unified_at timestamp").withColumn(
        "transaction_date", F.lit(AS_OF))
    got = {r.source_system: (r.freshness_status, r.sla_hours) for r in quality.source_freshness(df, P).collect()}
    assert got == {"stripe": ("healthy", 6), "plaid": ("warning", 24), "quickbooks": ("critical", 12),
                   "other": ("warning", None)}
