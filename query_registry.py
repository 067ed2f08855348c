"""Registered queries: key -> (Spark builder, oracle SELECT).

The Spark side builds the job over the driver tables of ``sf_dir``; the
oracle side is the final SELECT over the DuckDB CTEs of ``oracle.duck``
(``None`` where no SQL statement exists, e.g. multi-run operators).
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce as _reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import sinks as _sinks
from ledgerlake.functions import classify_amount as _classify
from ledgerlake.operators import checks as _checks
from ledgerlake.operators import joins as _joins
from ledgerlake.operators import snapshot as _snap
from ledgerlake.operators.json_rows import json_entries as _json_entries
from ledgerlake.plans import checks_suite as _suite
from ledgerlake.plans import marts, quality
from ledgerlake.plans import intermediate as _inter
from ledgerlake.plans import vault_models as _vm
from ledgerlake.plans.model import Model
from ledgerlake.session import shared_folder as _shared
from ledgerlake.sources import landing as _land
from ledgerlake.sources import netsuite as _ns
from ledgerlake.sources import seeds as _seeds
from ledgerlake.sources.driver_tables import MONEY as _MONEY, event_order


@dataclass(frozen=True)
class Query:
    spark: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, oracle: str | None):
    def deco(fn: Callable[[Model], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Model.from_driver(spark, sf_dir))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        REGISTRY[key] = Query(run, oracle)
        return fn

    return deco


def simple(key: str, attr_or_fn, cte: str):
    fn = attr_or_fn if callable(attr_or_fn) else (lambda m, a=attr_or_fn: getattr(m, a))
    register(key, f"SELECT * FROM {cte}")(fn)


# ---------------------------------------------------------------------------
# 2K staging M1-M13
# ---------------------------------------------------------------------------
simple("m1_stg_qb_accounts", lambda m: m.stg.qb_accounts(), "stg_qb_accounts")
simple("m2_stg_qb_customers", lambda m: m.stg.qb_customers(), "stg_qb_customers")
simple("m3_stg_qb_invoices", lambda m: m.stg.qb_invoices(), "stg_qb_invoices")
simple("m4_stg_qb_payments", lambda m: m.stg.qb_payments(), "stg_qb_payments")
simple("m5_stg_stripe_charges", lambda m: m.stg.stripe_charges(), "stg_stripe_charges")
simple("m6_stg_stripe_customers", lambda m: m.stg.stripe_customers(), "stg_stripe_customers")
simple("m7_stg_stripe_balance_txns", lambda m: m.stg.stripe_balance_transactions(), "stg_stripe_balance_transactions")
simple("m8_stg_ns_transactions", lambda m: m.stg.ns_transactions(), "stg_ns_transactions")
simple("m9_stg_ns_accounts", lambda m: m.stg.ns_accounts(), "stg_ns_accounts")
simple("m10_stg_plaid_transactions", lambda m: m.stg.plaid_transactions(), "stg_plaid_transactions")
simple("m11_stg_plaid_balances", lambda m: m.stg.plaid_balances(), "stg_plaid_balances")
simple("m12_stg_sf_accounts", lambda m: m.stg.sf_accounts(), "stg_sf_accounts")
simple("m13_stg_sf_opportunities", lambda m: m.stg.sf_opportunities(), "stg_sf_opportunities")

# ---------------------------------------------------------------------------
# 2K intermediate, marts, data quality
# ---------------------------------------------------------------------------
simple("m14_golden_customers", "golden", "golden_customers")
simple("m15_unified_transactions", "utx", "unified_transactions")
simple("m16_unified_chart_of_accounts", "chart_of_accounts", "chart_of_accounts")
simple("m26_fct_transactions", "fct_transactions", "fct_transactions")
simple("m27_fct_revenue", "fct_revenue", "fct_revenue")
simple("m28_fct_cash_flow", "fct_cash_flow", "fct_cash_flow")
simple("m29_fct_accounts_receivable", "fct_accounts_receivable", "fct_accounts_receivable")
simple("m30_dim_customers", "dim_customers", "dim_customers")
simple("m31_dim_accounts", "dim_accounts", "dim_accounts")


@register("m32_dim_date_by_transaction_date", """
SELECT d.*, coalesce(f.transaction_count, 0) AS transaction_count FROM dim_date d
LEFT JOIN (SELECT transaction_date, count(*) AS transaction_count FROM fct_transactions GROUP BY 1) f
  ON d.date_key = f.transaction_date""")
def _m32(m: Model) -> DataFrame:
    """Every day of the calendar dimension with the number of the fact table's transactions on it."""
    per_day = m.fct_transactions.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transaction_count"))
    return m.dim_date.join(per_day, m.dim_date.date_key == per_day.transaction_date, "left").drop(
        "transaction_date").withColumn("transaction_count", F.coalesce("transaction_count", F.lit(0)))
register(
    "m33_cross_source_reconciliation",
    "SELECT * FROM reconciliation_all WHERE reconciliation_status <> 'match'",
)(lambda m: m.dq_reconciliation)
simple("m34_golden_record_completeness", "dq_completeness", "golden_record_completeness")
simple("m35_source_freshness", "dq_freshness", "source_freshness")
register(
    "m36_transaction_anomalies",
    "SELECT * FROM anomalies_all WHERE is_count_anomaly OR is_amount_anomaly",
)(lambda m: m.dq_anomalies)


@register(
    "m29_ar_aging_summary",
    """SELECT aging_bucket, aging_bucket_sort, count(*) AS invoice_count,
         CAST(sum(total_amount) AS DECIMAL(28,4)) AS total_amount,
         CAST(sum(balance_due) AS DECIMAL(28,4)) AS balance_due
       FROM fct_accounts_receivable GROUP BY 1, 2""",
)
def _ar_summary(m: Model) -> DataFrame:
    """AR total per aging bucket (the flagship query)."""
    return marts.ar_aging_summary(m.fct_accounts_receivable)


@register("a9_daily_totals_by_source", "SELECT * FROM daily_totals_by_source")
def _a9(m: Model) -> DataFrame:
    """A9 step 1 / D23: per date, source and category totals (90 days)."""
    return quality.daily_totals_by_source(m.utx_by_month, m.p)


# ---------------------------------------------------------------------------
# 2L checks, G5 tally
# ---------------------------------------------------------------------------


@register("q1_q8_declared_checks", _suite.oracle_suite_sql())
def _declared(m: Model) -> DataFrame:
    """Q1-Q8: every declared column/table check, one result row each."""
    return _suite.run_suite(m)


@register("g5_check_tally", f"""SELECT count_if(status = 'pass') AS passed, count_if(status = 'fail') AS failed,
  count_if(status = 'warn') AS warnings, count_if(status = 'error') AS errors,
  count_if(status NOT IN ('pass', 'fail', 'warn', 'error') OR status IS NULL) AS skipped
FROM ({_suite.oracle_suite_sql()}) r""")
def _tally(m: Model) -> DataFrame:
    """Pass / fail / warn / error / skip counts over the declared checks."""
    return _checks.tally(_suite.run_suite(m))


@register("q10_balanced_debits_credits", """SELECT transaction_date, sum(total_debits) AS total_debits,
  sum(total_credits) AS total_credits FROM daily_totals_by_source GROUP BY 1
  HAVING abs(sum(total_debits) - sum(total_credits)) > 0.01""")
def _q10(m: Model) -> DataFrame:
    """Q10 applied to the daily debit/credit totals, grouped by date."""
    return _checks.balanced_debits_credits(quality.daily_totals_by_source(m.utx_by_month, m.p), "total_debits",
                                           "total_credits", "transaction_date")


@register("q11_orphan_rate", """SELECT total_rows, orphan_rows,
  round(CAST(orphan_rows AS DOUBLE) / nullif(CAST(total_rows AS DOUBLE), 0), 6) AS orphan_rate,
  coalesce(CAST(orphan_rows AS DOUBLE) / nullif(CAST(total_rows AS DOUBLE), 0) > 0.05, false) AS is_failing
FROM (SELECT count(*) AS total_rows, count_if(customer_key IS NULL) AS orphan_rows
      FROM fct_transactions WHERE entity_type = 'customer') s""")
def _q11(m: Model) -> DataFrame:
    """Q11: share of customer transactions without a golden customer key."""
    return _checks.orphan_rate(m.fct_transactions)


@register("q12_revenue_reconciliation", """
WITH rec AS (SELECT revenue_year, revenue_quarter, sum(revenue_amount) AS total_recognized FROM fct_revenue
             WHERE revenue_stage = 'recognized' AND revenue_year >= 2023 GROUP BY 1, 2),
     bk AS (SELECT revenue_year, revenue_quarter, sum(revenue_amount) AS total_booked FROM fct_revenue
            WHERE revenue_stage = 'booked' AND revenue_year >= 2023 GROUP BY 1, 2),
     comp AS (SELECT coalesce(r.revenue_year, b.revenue_year) AS year,
                coalesce(r.revenue_quarter, b.revenue_quarter) AS quarter,
                CAST(coalesce(r.total_recognized, 0) AS DECIMAL(28,9)) AS recognized,
                CAST(coalesce(b.total_booked, 0) AS DECIMAL(28,9)) AS booked,
                CAST(abs(coalesce(r.total_recognized, 0) - coalesce(b.total_booked, 0)) AS DECIMAL(28,9)) AS variance
              FROM rec r FULL OUTER JOIN bk b ON r.revenue_year = b.revenue_year AND r.revenue_quarter = b.revenue_quarter)
SELECT * FROM comp WHERE booked > 0 AND CAST(variance AS DOUBLE) / CAST(booked AS DOUBLE) > 0.10
  AND CAST(year AS VARCHAR) || CAST(quarter AS VARCHAR) < CAST(year(DATE '2024-01-31') AS VARCHAR)
      || CAST(quarter(DATE '2024-01-31') AS VARCHAR)""")
def _q12(m: Model) -> DataFrame:
    """Q12: completed quarters since 2023 with recognized revenue > 10 % off booked."""
    return _checks.revenue_reconciliation(m.fct_revenue, m.p.as_of)


# ---------------------------------------------------------------------------
# Vault M17-M25: two runs -- the target is built from the rows loaded up to a
# cut-off, then the full batch is applied incrementally (J8/J9 anti-joins).
# The result must equal a one-shot build (the oracle).
# ---------------------------------------------------------------------------
CUTOFF = "2024-01-20 06:00:00"


def _two_runs(loader, frames, load_col):
    first = [f.filter(F.col(load_col) <= F.lit(CUTOFF).cast("timestamp")) for f in frames]
    target = loader(*first)
    new = loader(*frames, target=target)
    return target.unionByName(new)


_HUB_ORACLE = """SELECT {hk} AS {key}, bk AS {bkname}, record_source, min(load_date) AS load_date FROM ({src}) s
GROUP BY ALL"""


def _hub_sql(key, bkname, parts):
    src = " UNION ALL ".join(f"SELECT {bk} AS bk, {rs} AS record_source, {ld} AS load_date FROM {t}"
                             for t, bk, rs, ld in parts)
    from oracle.duck import sk
    return _HUB_ORACLE.format(hk=sk("bk", "record_source"), key=key, bkname=bkname, src=src)


@register("m17_hub_customer", _hub_sql("hub_customer_hk", "customer_bk", [
    ("stg_qb_customers", "customer_id", "'quickbooks'", "_loaded_at"),
    ("stg_stripe_customers", "stripe_customer_id", "'stripe'", "_loaded_at"),
    ("stg_sf_accounts", "sf_account_id", "'salesforce'", "_loaded_at")]))
def _m17(m: Model) -> DataFrame:
    """M17 hub_customer, loaded in two incremental runs."""
    return _two_runs(_vm.hub_customer, [m.stg.qb_customers(), m.stg.stripe_customers(), m.stg.sf_accounts()],
                     "_loaded_at")


@register("m18_hub_account", _hub_sql("hub_account_hk", "account_bk", [
    ("stg_qb_accounts", "account_id", "'quickbooks'", "_loaded_at"),
    ("stg_ns_accounts", "account_id", "'netsuite'", "_loaded_at")]))
def _m18(m: Model) -> DataFrame:
    """M18 hub_account, loaded in two incremental runs."""
    return _two_runs(_vm.hub_account, [m.stg.qb_accounts(), m.stg.ns_accounts()], "_loaded_at")


@register("m19_hub_transaction", _hub_sql("hub_transaction_hk", "transaction_bk", [
    ("unified_transactions", "transaction_unified_id", "source_system", "_unified_at")]))
def _m19(m: Model) -> DataFrame:
    """M19 hub_transaction (first run on rows loaded up to the cut-off)."""
    first = m.spine.filter(F.col("_loaded_at") <= F.lit(CUTOFF).cast("timestamp"))
    target = _vm.hub_transaction(first, deal_once=True)
    return target.unionByName(_vm.hub_transaction(m.spine, target=target, deal_once=True))


def _link_sql(key, names, src):
    from oracle.duck import sk
    return (f"SELECT {sk(*names)} AS {key}, {', '.join(names)}, record_source, min(load_date) AS load_date "
            f"FROM ({src}) s GROUP BY ALL")


def _sk(*a):
    from oracle.duck import sk
    return sk(*a)


@register("m20_lnk_customer_account", _link_sql(
    "lnk_customer_account_hk", ["hub_customer_hk", "hub_account_hk"],
    f"SELECT {_sk('customer_id', chr(39) + 'quickbooks' + chr(39))} AS hub_customer_hk, "
    f"{_sk(chr(39) + '1100' + chr(39), chr(39) + 'quickbooks' + chr(39))} AS hub_account_hk, "
    "'quickbooks' AS record_source, _loaded_at AS load_date FROM stg_qb_invoices WHERE customer_id IS NOT NULL"))
def _m20(m: Model) -> DataFrame:
    """M20 lnk_customer_account, two incremental runs."""
    return _two_runs(_vm.lnk_customer_account, [m.stg.qb_invoices()], "_loaded_at")


@register("m21_lnk_transaction_account", _link_sql(
    "lnk_transaction_account_hk", ["hub_transaction_hk", "hub_account_hk"],
    f"SELECT {_sk('transaction_unified_id', 'source_system')} AS hub_transaction_hk, "
    f"{_sk('source_entity_id', 'source_system')} AS hub_account_hk, source_system AS record_source, "
    "_unified_at AS load_date FROM unified_transactions WHERE source_entity_id IS NOT NULL"))
def _m21(m: Model) -> DataFrame:
    """M21 lnk_transaction_account, two incremental runs (split on _loaded_at)."""
    first = m.spine.filter(F.col("_loaded_at") <= F.lit(CUTOFF).cast("timestamp"))
    target = _vm.lnk_transaction_account(first, deal_once=True)
    return target.unionByName(_vm.lnk_transaction_account(m.spine, target=target, deal_once=True))


def _sat_sql(key, hub_key_expr, hub_key_name, hash_cols, payload, rs, ld, table):
    from oracle.duck import sk
    pl = ", ".join(f"{src} AS {dst}" for dst, src in payload)
    return (f"SELECT {sk(hub_key_name, 'load_date')} AS {key}, * FROM (SELECT {hub_key_expr} AS {hub_key_name}, "
            f"{sk(*hash_cols)} AS hash_diff, {pl}, {rs} AS record_source, {ld} AS load_date FROM {table}) s")


_CD = ["display_name", "company_name", "first_name", "last_name", "email", "phone", "billing_address_line1",
       "billing_city", "billing_state", "billing_postal_code", "billing_country", "is_active", "outstanding_balance",
       "currency_code"]


@register("m22_sat_customer_details", _sat_sql(
    "sat_customer_details_hk", _sk("customer_id", "'quickbooks'"), "hub_customer_hk",
    ["display_name", "company_name", "first_name", "last_name", "email", "phone", "billing_address_line1",
     "billing_city", "billing_state", "billing_postal_code", "is_active", "outstanding_balance"],
    [(c, c) for c in _CD], "'quickbooks'", "_loaded_at", "stg_qb_customers"))
def _m22(m: Model) -> DataFrame:
    """M22 sat_customer_details, two incremental runs."""
    return _two_runs(_vm.sat_customer_details, [m.stg.qb_customers()], "_loaded_at")


_CS = ["customer_name", "email", "phone", "address_line1", "city", "state", "postal_code", "country",
       "currency_code", "is_delinquent"]


@register("m23_sat_customer_stripe", _sat_sql(
    "sat_customer_stripe_hk", _sk("stripe_customer_id", "'stripe'"), "hub_customer_hk",
    ["customer_name", "email", "phone", "city", "state", "is_delinquent", "quickbooks_customer_id",
     "netsuite_customer_id", "salesforce_account_id"],
    [(c, c) for c in _CS] + [("xref_quickbooks_id", "quickbooks_customer_id"),
                             ("xref_netsuite_id", "netsuite_customer_id"),
                             ("xref_salesforce_id", "salesforce_account_id")],
    "'stripe'", "_loaded_at", "stg_stripe_customers"))
def _m23(m: Model) -> DataFrame:
    """M23 sat_customer_stripe, two incremental runs."""
    return _two_runs(_vm.sat_customer_stripe, [m.stg.stripe_customers()], "_loaded_at")


@register("m24_sat_account_balance", _sat_sql(
    "sat_account_balance_hk", _sk("account_id", "'quickbooks'"), "hub_account_hk", ["current_balance", "is_active"],
    [(c, c) for c in ["account_name", "current_balance", "currency_code", "is_active"]],
    "'quickbooks'", "_loaded_at", "stg_qb_accounts"))
def _m24(m: Model) -> DataFrame:
    """M24 sat_account_balance, two incremental runs."""
    return _two_runs(_vm.sat_account_balance, [m.stg.qb_accounts()], "_loaded_at")


@register("m25_sat_transaction_details", _sat_sql(
    "sat_transaction_details_hk", _sk("transaction_unified_id", "source_system"), "hub_transaction_hk",
    ["transaction_type", "transaction_category", "amount", "status", "reference_number", "memo"],
    [(c, c) for c in ["transaction_type", "transaction_category", "amount", "currency_code", "transaction_date",
                      "status", "reference_number", "memo"]],
    "source_system", "_unified_at", "unified_transactions"))
def _m25(m: Model) -> DataFrame:
    """M25 sat_transaction_details (first run on rows loaded up to the cut-off)."""
    first = m.spine.filter(F.col("_loaded_at") <= F.lit(CUTOFF).cast("timestamp"))
    target = _vm.sat_transaction_details(first, deal_once=True)
    return target.unionByName(_vm.sat_transaction_details(m.spine, target=target, deal_once=True))


# ---------------------------------------------------------------------------
# M37 snapshot: two daily runs of dim_customers; the snapshot's updated_at is
# the dimension's build time (reference configuration), so the second run
# versions every customer.
# ---------------------------------------------------------------------------
RUN1_TS = "2024-01-30 06:00:00"


@register("m37_snap_dim_customers", f"""
SELECT * EXCLUDE (_v) FROM (
  SELECT * REPLACE (TIMESTAMP '{RUN1_TS}' AS _dim_updated_at),
    md5(customer_key || '|' || '{RUN1_TS}') AS dbt_scd_id, TIMESTAMP '{RUN1_TS}' AS dbt_updated_at,
    TIMESTAMP '{RUN1_TS}' AS dbt_valid_from, TIMESTAMP '2024-01-31 06:00:00' AS dbt_valid_to, 1 AS _v
  FROM dim_customers
  UNION ALL
  SELECT *, md5(customer_key || '|' || '2024-01-31 06:00:00'), _dim_updated_at, _dim_updated_at,
    CAST(NULL AS TIMESTAMP), 2
  FROM dim_customers) s""")
def _m37(m: Model) -> DataFrame:
    """SCD2 snapshot of dim_customers after two runs (timestamp strategy)."""
    run1 = m.dim_customers.withColumn("_dim_updated_at", F.lit(RUN1_TS).cast("timestamp"))
    snap1 = _snap.snapshot(run1, None, "customer_key", "_dim_updated_at", RUN1_TS)
    return _snap.snapshot(m.dim_customers, snap1, "customer_key", "_dim_updated_at", m.p.run_ts)


# ---------------------------------------------------------------------------
# 2A sources: landing, look-back, NetSuite pulls, freshness, incremental merge
# ---------------------------------------------------------------------------


@register("s6_plaid_balance_snapshot", """
SELECT account_id, current, CAST(current - 25 AS DECIMAL(18,4)) AS available, CAST(NULL AS DECIMAL(18,4)) AS "limit",
  'usd' AS iso_currency_code, DATE '2024-01-31' AS snapshot_date,
  TIMESTAMP '2024-01-31 06:00:00' AS _loaded_at, 'plaid' AS _source_system
FROM (SELECT 'acc_' || CAST(user_id % 10 AS VARCHAR) AS account_id,
        CAST(CAST(value AS DECIMAL(18,4)) * 100 AS DECIMAL(18,4)) AS current
      FROM events WHERE event_type IN ('click', 'signup')
      QUALIFY row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts DESC, event_id DESC) = 1) b""")
def _s6(m: Model) -> DataFrame:
    """S6 + S2: flatten the nested balance extract (latest balance per account), stamp the batch."""
    ev = m.raw.driver("events").filter(F.col("event_type").isin("click", "signup"))
    last = ev.groupBy((F.col("user_id") % 10).alias("_a")).agg(
        F.max_by("value", event_order()).alias("_v"))
    cur = (F.col("_v").cast(_MONEY) * 100).cast(_MONEY)
    nested = last.select(
        F.concat(F.lit("acc_"), F.col("_a").cast("string")).alias("account_id"),
        F.struct(cur.alias("current"), (cur - 25).cast(_MONEY).alias("available"),
                  F.lit(None).cast(_MONEY).alias("limit"), F.lit("usd").alias("iso_currency_code")).alias("balances"),
    )
    return _land.stamp(_land.flatten_balances(nested, m.p.run_ts), m.p.run_ts, "plaid")


@register("s8_plaid_lookback", """SELECT *, 'plaid' AS _source_system FROM raw_plaid_transactions
WHERE date BETWEEN DATE '2024-01-31' - 30 AND DATE '2024-01-31'""")
def _s8(m: Model) -> DataFrame:
    """Plaid transactions within the 30-day look-back of the run date."""
    return _land.lookback(m.raw("plaid.transactions"), "date", m.p.as_of, 30)


@register("s9_netsuite_transactions_pull", """
SELECT id, tranId AS tran_id, type, status, entity, subsidiary, department, currency, exchangeRate AS exchange_rate,
  total, tranDate AS tran_date, dueDate AS due_date, posting, voided, memo, dateCreated AS date_created,
  lastModifiedDate AS last_modified_date
FROM ns_system_transactions WHERE tranDate >= DATE '2020-01-01'""")
def _s9(m: Model) -> DataFrame:
    """NetSuite transaction pull (renames, tranDate >= 2020-01-01)."""
    return _ns.pull_transactions(_ns.system_transactions(m.raw.driver("lineitem")), m.p.min_transaction_date)


@register("s10_netsuite_lines_pull", """
SELECT tl.* FROM ns_system_lines tl JOIN ns_system_transactions t ON tl.transaction = t.id
WHERE t.tranDate >= DATE '2020-01-01'""")
def _s10(m: Model) -> DataFrame:
    """Transaction lines scoped by their parent's date."""
    li = m.raw.driver("lineitem")
    return _ns.pull_transaction_lines(_ns.system_transaction_lines(li), _ns.system_transactions(li),
                                      m.p.min_transaction_date)


@register("s11_netsuite_customers_pull", """SELECT id, entityId AS entity_id, companyName AS company_name, email,
  phone, isInactive AS is_inactive, dateCreated AS date_created FROM ns_system_customers""")
def _s11c(m: Model) -> DataFrame:
    """NetSuite customer master pull."""
    return _ns.pull_entities(_ns.system_customers(m.raw.driver("customer")))


@register("s11_netsuite_vendors_pull", """SELECT id, entityId AS entity_id, companyName AS company_name, email,
  phone, isInactive AS is_inactive, dateCreated AS date_created FROM ns_system_vendors""")
def _s11v(m: Model) -> DataFrame:
    """NetSuite vendor master pull."""
    return _ns.pull_entities(_ns.system_vendors(m.raw.driver("supplier")))


@register("s11_netsuite_accounts_pull", """SELECT id, acctName AS acct_name, acctNumber AS acct_number, acctType AS acct_type,
  generalRateType AS general_rate_type, parent, isInactive AS is_inactive FROM ns_system_accounts""")
def _s11a(m: Model) -> DataFrame:
    """NetSuite account master pull."""
    return _ns.pull_accounts(_ns.system_accounts(m.raw.driver("supplier")))


@register("s13_currency_totals", """
SELECT c.currency_code, c.currency_name, c.symbol, c.decimal_places, count(i.invoice_id) AS invoices,
  CAST(sum(i.total_amount) AS DECIMAL(28,4)) AS total
FROM (VALUES ('USD', 'US Dollar', '$', 2), ('EUR', 'Euro', '€', 2), ('GBP', 'British Pound', '£', 2), ('CAD', 'Canadian Dollar', 'C$', 2),
  ('AUD', 'Australian Dollar', 'A$', 2), ('JPY', 'Japanese Yen', '¥', 0), ('CHF', 'Swiss Franc', 'CHF', 2))
  c(currency_code, currency_name, symbol, decimal_places)
LEFT JOIN stg_qb_invoices i ON i.currency_code = c.currency_code GROUP BY ALL""")
def _s13(m: Model) -> DataFrame:
    """The currency seed, written as its CSV file and read with the pinned schema, beside the invoices of each currency."""
    path = f"{_shared(m.spark)}/s13-{_uuid.uuid4().hex}"
    _seeds.currency_codes(m.spark).coalesce(1).write.option("header", True).csv(path)
    seed = _seeds.currency_codes(m.spark, path)
    sums = m.stg.qb_invoices().groupBy(F.col("currency_code").alias("_code")).agg(
        F.count("invoice_id").alias("invoices"), F.sum("total_amount").cast("decimal(28,4)").alias("total"))
    return seed.join(sums, F.col("currency_code") == F.col("_code"), "left").select(
        "currency_code", "currency_name", "symbol", "decimal_places", F.coalesce("invoices", F.lit(0)).alias("invoices"), "total")


@register("s11_netsuite_subsidiaries_pull", """SELECT id, name, country, currency, isInactive AS is_inactive
FROM ns_system_subsidiaries""")
def _s11s(m: Model) -> DataFrame:
    """NetSuite subsidiaries pull."""
    return _ns.pull_subsidiaries(_ns.system_subsidiaries(m.raw.driver("nation")))


@register("s11_netsuite_departments_pull", """SELECT id, name, parent, isInactive AS is_inactive
FROM ns_system_departments""")
def _s11d(m: Model) -> DataFrame:
    """NetSuite departments pull."""
    return _ns.pull_departments(_ns.system_departments(m.raw.driver("region")))


@register("q10_balanced_transaction_lines", """
SELECT transaction, sum(debit) AS total_debits, sum(credit) AS total_credits FROM (
  SELECT tl.* FROM ns_system_lines tl JOIN ns_system_transactions t ON tl.transaction = t.id
  WHERE t.tranDate >= DATE '2020-01-01') l
GROUP BY 1 HAVING abs(sum(debit) - sum(credit)) > 0.01""")
def _q10l(m: Model) -> DataFrame:
    """Q10 on the pulled NetSuite lines: transactions whose debits and credits differ."""
    return _checks.balanced_debits_credits(_s10(m), "debit", "credit", "transaction")


_RAW_ALL = ["quickbooks.customers", "quickbooks.invoices", "quickbooks.payments", "quickbooks.accounts",
            "netsuite.accounts", "netsuite.transactions", "stripe.customers", "stripe.charges",
            "stripe.balance_transactions", "plaid.transactions", "plaid.balances", "salesforce.accounts",
            "salesforce.opportunities"]


def _q9_sql():
    parts = {"quickbooks": ["raw_qb_customers", "raw_qb_invoices", "raw_qb_payments", "raw_qb_accounts"],
             "netsuite": ["raw_ns_accounts", "raw_ns_transactions"],
             "stripe": ["raw_stripe_customers", "raw_stripe_charges", "raw_stripe_balance_transactions"],
             "plaid": ["raw_plaid_transactions", "raw_plaid_balances"],
             "salesforce": ["raw_sf_accounts", "raw_sf_opportunities"]}
    thr = {"quickbooks": (12, 24), "stripe": (6, 12), "netsuite": (12, 24), "plaid": (24, 48), "salesforce": (12, 24)}
    u = " UNION ALL ".join(f"SELECT '{s}' AS source, _loaded_at FROM {t}" for s, ts in parts.items() for t in ts)
    warn = "CASE source " + " ".join(f"WHEN '{s}' THEN {w}" for s, (w, e) in thr.items()) + " END"
    err = "CASE source " + " ".join(f"WHEN '{s}' THEN {e}" for s, (w, e) in thr.items()) + " END"
    h = "date_sub('hour', max_loaded_at, TIMESTAMP '2024-01-31 06:00:00')"
    return (f"SELECT source, max_loaded_at, {h} AS hours_since_load, {warn} AS warn_after_hours, "
            f"{err} AS error_after_hours, CASE WHEN {h} IS NULL OR {h} > {err} THEN 'error' WHEN {h} > {warn} "
            f"THEN 'warn' ELSE 'pass' END AS status FROM (SELECT source, max(_loaded_at) AS max_loaded_at "
            f"FROM ({u}) u GROUP BY 1) m")


@register("q9_source_freshness", _q9_sql())
def _q9(m: Model) -> DataFrame:
    """Q9: per source, hours since the newest _loaded_at against warn/error thresholds."""
    return _land.source_freshness(m.raw, _RAW_ALL, m.p.run_ts)


@register("s16_utx_incremental_merge", "SELECT * FROM unified_transactions")
def _s16(m: Model) -> DataFrame:
    """S16-S18 + F11: first run builds the spine from rows loaded up to a cut-off;
    the second run re-reads each source from its watermark minus the 3-day
    look-back and merges on transaction_unified_id. Equals a one-shot build."""
    first = _inter.unified_transactions(m.stg, m.p).filter(F.col("_loaded_at") <= F.lit(CUTOFF).cast("timestamp"))
    wm = _sinks.high_watermark(first, "_loaded_at", by="source_system")
    batch = _inter.unified_transactions(m.stg, m.p, watermarks=wm)
    return _sinks.merge_frames(first, batch, ["transaction_unified_id"])


# ---------------------------------------------------------------------------
# Operator-level queries (2C-2J) over the same derived tables
# ---------------------------------------------------------------------------

RUN1 = "2024-01-30 06:00:00"


def _utx_two_runs(m: Model):
    """The spine as an incremental table after two daily runs: rows loaded by
    the cut-off carry run 1's _unified_at, rows re-read by run 2 carry run 2's.
    The first run's rows come without the columns that ``with_ids`` makes, with the parameters to make them."""
    from dataclasses import replace
    p1 = replace(m.p, run_ts=_dt.datetime.fromisoformat(RUN1))
    rows = _inter.spine_rows(m.stg, p1).filter(F.col("_loaded_at") <= F.lit(CUTOFF).cast("timestamp"))
    wm = _sinks.high_watermark(rows, "_loaded_at", by="source_system")
    batch = _inter.unified_transactions(m.stg, m.p, watermarks=wm)
    return rows, p1, _sinks.merge_frames(_inter.with_ids(rows, p1), batch, ["transaction_unified_id"])


_UTX2 = f"""
WITH wm AS (SELECT source_system, max(_loaded_at) AS wm FROM unified_transactions
            WHERE _loaded_at <= TIMESTAMP '{CUTOFF}' GROUP BY 1),
     utx2 AS (SELECT u.transaction_unified_id,
                CASE WHEN u._loaded_at > w.wm - INTERVAL 3 DAY THEN TIMESTAMP '2024-01-31 06:00:00'
                     ELSE TIMESTAMP '{RUN1}' END AS _unified_at2
              FROM unified_transactions u JOIN wm w USING (source_system))
SELECT f.* REPLACE (u2._unified_at2 AS _unified_at)
FROM fct_transactions f JOIN utx2 u2 ON f.transaction_key = u2.transaction_unified_id"""


@register("f10_fct_transactions_incremental", _UTX2)
def _f10(m: Model) -> DataFrame:
    """F10 + A7 + S16: fct_transactions built on run 1, then loaded incrementally
    with `_unified_at > max(_unified_at)` of the target and merged on transaction_key."""
    rows, p1, utx_table = _utx_two_runs(m)
    first_utx = _inter.with_ids(rows, p1)
    # fct passes _unified_at through from the spine and keeps every spine row
    # (left join), so max over the first run's spine = max over its fct, and a batch has its spine rows' keys
    hwm = _sinks.high_watermark(first_utx, "_unified_at")
    new_rows = utx_table if hwm is None else utx_table.filter(F.col("_unified_at") > F.lit(hwm))
    fct_batch = marts.fct_transactions(new_rows, m.golden)
    # a row of the first run's fct follows from its spine row: those the batch replaces go before the customer join
    return _sinks.merge_frames(
        rows, fct_batch, ["transaction_key"], key_of={"transaction_key": _inter.spine_id()},
        finish=lambda df: marts.fct_transactions(df, m.golden, lambda joined: _inter.with_ids(joined, p1)),
        batch_keys=new_rows.select(F.col("transaction_unified_id").alias("transaction_key")))


@register("j6_a11_revenue_comparison", """
SELECT coalesce(r.revenue_year, b.revenue_year) AS year, coalesce(r.revenue_quarter, b.revenue_quarter) AS quarter,
  CAST(coalesce(r.total_recognized, 0) AS DECIMAL(28,9)) AS recognized,
  CAST(coalesce(b.total_booked, 0) AS DECIMAL(28,9)) AS booked,
  CAST(abs(coalesce(r.total_recognized, 0) - coalesce(b.total_booked, 0)) AS DECIMAL(28,9)) AS variance
FROM (SELECT revenue_year, revenue_quarter, sum(revenue_amount) AS total_recognized FROM fct_revenue
      WHERE revenue_stage = 'recognized' AND revenue_year >= 2023 GROUP BY 1, 2) r
FULL OUTER JOIN (SELECT revenue_year, revenue_quarter, sum(revenue_amount) AS total_booked FROM fct_revenue
      WHERE revenue_stage = 'booked' AND revenue_year >= 2023 GROUP BY 1, 2) b
ON r.revenue_year = b.revenue_year AND r.revenue_quarter = b.revenue_quarter""")
def _j6(m: Model) -> DataFrame:
    """J6 + A11: recognized vs booked revenue per year and quarter (full outer join, all quarters)."""
    return _checks.revenue_reconciliation(m.fct_revenue, m.p.as_of, threshold=-1.0, completed_only=False)


@register("j10_customer_lookup", """
SELECT customer_golden_id, stripe_customer_id AS source_id, 'stripe' AS sys FROM golden_customers
  WHERE stripe_customer_id IS NOT NULL
UNION ALL SELECT customer_golden_id, quickbooks_customer_id, 'quickbooks' FROM golden_customers
  WHERE quickbooks_customer_id IS NOT NULL
UNION ALL SELECT customer_golden_id, netsuite_customer_id, 'netsuite' FROM golden_customers
  WHERE netsuite_customer_id IS NOT NULL""")
def _j10(m: Model) -> DataFrame:
    """One-pass unpivot of the golden id columns into (owner, source_id, system)."""
    return marts.customer_lookup(m.golden)


@register("j7_unreferenced_qb_customers", """
SELECT customer_id, email FROM stg_qb_customers
WHERE email IS NOT NULL AND customer_id NOT IN (
  SELECT quickbooks_customer_id FROM stg_stripe_customers
  WHERE stripe_customer_id IS NOT NULL AND quickbooks_customer_id IS NOT NULL)""")
def _j7(m: Model) -> DataFrame:
    """QuickBooks customers that no Stripe metadata references (NULL-safe NOT IN as left_anti)."""
    qb = m.stg.qb_customers().filter(F.col("email").isNotNull()).select("customer_id", "email")
    st = m.stg.stripe_customers().filter(F.col("stripe_customer_id").isNotNull())
    return _joins.not_in(qb, "customer_id", st, "quickbooks_customer_id")


@register("a2_a3_customer_metrics", """
SELECT customer_key, count(DISTINCT transaction_key) AS lifetime_transaction_count,
  CAST(sum(amount) AS DECIMAL(28,9)) AS lifetime_transaction_value,
  CAST(sum(revenue_amount) AS DECIMAL(28,9)) AS lifetime_revenue,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
  count(DISTINCT source_system) AS source_system_count
FROM fct_transactions WHERE customer_key IS NOT NULL GROUP BY 1""")
def _a3(m: Model) -> DataFrame:
    """A2 + A3: per-customer lifetime metrics with two exact distinct counts."""
    return marts.customer_metrics(m.fct_transactions)


def _entries_sql(name: str, table: str, col: str, key: str) -> str:
    return f"""SELECT '{name}' AS document, id, field, json_extract_string(doc, path) AS value,
  json_type(doc, path) IN ('OBJECT', 'ARRAY') AS is_nested
FROM (SELECT *, '$."' || field || '"' AS path FROM (SELECT id, doc, unnest(json_keys(doc)) AS field
  FROM (SELECT {key} AS id, CASE WHEN json_valid({col}) THEN {col} END AS doc FROM {table}) d WHERE doc IS NOT NULL) k) p"""


@register("x7_x8_json_entries", "\nUNION ALL\n".join(_entries_sql(*d) for d in (
    ("customer.metadata", "raw_stripe_customers", "metadata", "id"), ("customer.address", "raw_stripe_customers", "address", "id"),
    ("charge.metadata", "raw_stripe_charges", "metadata", "id"))))
def _x78(m: Model) -> DataFrame:
    """X7 + X8: every key of the customers' metadata and address documents and of
    the charges' metadata, as rows; no key is named."""
    docs = (("customer.metadata", "stripe.customers", "metadata"), ("customer.address", "stripe.customers", "address"),
            ("charge.metadata", "stripe.charges", "metadata"))
    parts = [_json_entries(m.raw(t), c, ["id"]).withColumn("document", F.lit(name)) for name, t, c in docs]
    return _reduce(DataFrame.unionByName, parts)


@register("w1_w4_rolling_stats", "SELECT * FROM anomalies_all")
def _w(m: Model) -> DataFrame:
    """Trailing 30-row mean / stddev, guarded z-scores and 2-sigma flags, every day."""
    return quality.transaction_anomalies(m.utx_by_month, m.p, flagged_only=False)


@register("a4_accounting_vs_bank_all_days", "SELECT * FROM reconciliation_all")
def _a4(m: Model) -> DataFrame:
    """A4 + X24: accounting vs bank vs Stripe per day and category, matches kept."""
    return quality.cross_source_reconciliation(m.utx_by_month, m.p, keep_matches=True)


@register("g3_amount_classes", """
SELECT source_system, CASE WHEN amount > 0 THEN 'debit' WHEN amount < 0 THEN 'credit' ELSE 'zero' END AS amount_class,
  count(*) AS n, CAST(sum(amount) AS DECIMAL(28,9)) AS total
FROM unified_transactions GROUP BY 1, 2""")
def _g3(m: Model) -> DataFrame:
    """Debit / credit / zero classification of every spine amount, per source."""
    return m.utx.groupBy("source_system", _classify("amount").alias("amount_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(28,9)").alias("total"))


# the queries that write tables and read them back
import table_queries  # noqa: E402

table_queries.add(register)
