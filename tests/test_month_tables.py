"""The spine is read by month and by column."""

from ledgerlake.plans import quality
from ledgerlake.plans.model import Model

SF = "/root/testdata/sf0.001"


def scan_of(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "FileScan parquet" in x]


def test_quality_jobs_open_the_months_they_need_and_few_columns(spark):
    m = Model.from_driver(spark, SF)
    for job in (quality.daily_totals_by_source(m.utx_by_month, m.p), m.dq_reconciliation, m.dq_anomalies):
        scans = scan_of(job)
        assert scans and all("transaction_date_month" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
        assert all("transaction_unified_id" not in s.split("ReadSchema")[1] for s in scans)
    assert all("memo" not in s.split("ReadSchema")[1] for s in scan_of(m.dq_freshness))


def test_month_bound_keeps_every_row_of_the_window(spark):
    m = Model.from_driver(spark, SF)
    for days in (0, 7, 31, 90):
        bounded, plain = quality.since(m.utx_by_month, m.p, days), quality.since(m.utx, m.p, days)
        assert bounded.count() == plain.count()
