"""Finance marts M26-M32."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import (
    BASE,
    date_spine,
    day_diff,
    lit_date,
    lit_ts,
    month_boundaries,
    null_of,
    surrogate_key,
    week_of_year_sunday,
)
from ledgerlake.operators.joins import id_lookup, left_join_matchable, left_join_spread
from ledgerlake.params import DEFAULT, RunParams

# decimal type of aggregated money columns (sum of BASE, cast back)
AMT = BASE

LOOKUP_SYSTEMS = {"stripe": "stripe_customer_id", "quickbooks": "quickbooks_customer_id", "netsuite": "netsuite_customer_id"}


# ---------------------------------------------------------------------------
# M26 fct_transactions
# ---------------------------------------------------------------------------
def customer_lookup(golden: DataFrame) -> DataFrame:
    """(customer_golden_id, source_id, sys) -- Plaid ids are never looked up."""
    return id_lookup(golden, "customer_golden_id", LOOKUP_SYSTEMS)


def fct_transactions(utx: DataFrame, golden: DataFrame, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """M26. The lookup grows with the customers, and the size estimated from its compressed files is a
    tenth of its rows': it is never broadcast on that estimate, the join is the same at every size.

    ``utx`` may be the spine's narrower rows with ``finish`` to make whole rows of them after the join."""
    lk = customer_lookup(golden)
    # rows from systems without a lookup (plaid) or with no entity id can
    # never match: they pass beside the join
    j = left_join_matchable(
        utx,
        lk.hint("merge"),
        [("source_entity_id", "source_id"), ("source_system", "sys")],
        matchable=F.col("source_system").isin(*LOOKUP_SYSTEMS),
    )
    j = finish(j) if finish else j
    cat = F.col("transaction_category")
    amt = F.col("amount")
    zero = F.lit(0).cast(AMT)
    return j.select(
        F.col("transaction_unified_id").alias("transaction_key"),
        "source_transaction_id",
        F.col("customer_golden_id").alias("customer_key"),
        F.col("transaction_date").alias("date_key"),
        # The reference reads transaction_date downstream but only outputs date_key
        "transaction_date",
        "transaction_type", "transaction_category", "entity_type", "status", "reference_number", "memo",
        "source_system",
        amt.alias("amount"),
        "currency_code",
        F.when(cat == "cash_receipt", amt).otherwise(zero).cast(AMT).alias("cash_inflow"),
        F.when(cat == "cash_disbursement", F.abs(amt)).otherwise(zero).cast(AMT).alias("cash_outflow"),
        F.when(cat == "accounts_receivable", amt).otherwise(zero).cast(AMT).alias("revenue_amount"),
        F.col("created_at").alias("transaction_created_at"),
        "_unified_at",
    )


# ---------------------------------------------------------------------------
# M27 fct_revenue
# ---------------------------------------------------------------------------
REVENUE_COLUMNS = ["transaction_key", "customer_key", "revenue_date", "revenue_amount", "currency_code",
                   "revenue_stage", "source_system", "reference_number"]


def fct_revenue(fct: DataFrame, opportunities: DataFrame, golden: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    invoiced = fct.filter((F.col("transaction_category") == "accounts_receivable") & (F.col("amount") > 0)).select(
        "transaction_key", "customer_key",
        F.col("transaction_date").alias("revenue_date"),
        F.col("amount").cast(AMT).alias("revenue_amount"),
        "currency_code",
        F.lit("recognized").alias("revenue_stage"),
        "source_system", "reference_number",
    )
    gc = golden.filter(F.col("salesforce_account_id").isNotNull()).select(
        F.col("customer_golden_id").alias("customer_key"), F.col("salesforce_account_id").alias("_sf")
    )
    opp = left_join_spread(opportunities, gc, [("sf_account_id", "_sf")], spread_col="opportunity_id")
    booked = opp.select(
        surrogate_key("opportunity_id").alias("transaction_key"),
        "customer_key",
        F.col("close_date").alias("revenue_date"),
        F.col("amount").cast(AMT).alias("revenue_amount"),
        "currency_code",
        F.when(F.col("is_won"), "booked").when(F.col("is_closed"), "lost").otherwise("pipeline").alias("revenue_stage"),
        F.lit("salesforce").alias("source_system"),
        F.col("opportunity_name").alias("reference_number"),
    )
    u = invoiced.select(*REVENUE_COLUMNS).unionByName(booked.select(*REVENUE_COLUMNS))
    d = F.col("revenue_date")
    return u.select(
        *REVENUE_COLUMNS,
        F.year(d).alias("revenue_year"),
        F.quarter(d).alias("revenue_quarter"),
        F.month(d).alias("revenue_month"),
        lit_ts(p.run_ts).alias("_loaded_at"),
    )


# ---------------------------------------------------------------------------
# M28 fct_cash_flow
# ---------------------------------------------------------------------------
CASH_COLUMNS = ["cash_flow_id", "bank_account_id", "cash_flow_date", "amount", "currency_code", "inflow_amount",
                "outflow_amount", "category", "subcategory", "counterparty", "payment_channel", "source_system",
                "cash_flow_type"]


def fct_cash_flow(plaid_txns: DataFrame, stripe_bt: DataFrame, balances: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    zero = F.lit(0).cast(AMT)

    def split(a):
        return (
            F.when(a > 0, a).otherwise(zero).cast(AMT).alias("inflow_amount"),
            F.when(a < 0, F.abs(a)).otherwise(zero).cast(AMT).alias("outflow_amount"),
        )

    a = F.col("amount")
    bank = plaid_txns.select(
        F.col("plaid_transaction_id").alias("cash_flow_id"),
        F.col("plaid_account_id").alias("bank_account_id"),
        F.col("transaction_date").alias("cash_flow_date"),
        a.cast(AMT).alias("amount"),
        "currency_code",
        *split(a),
        F.col("pfc_primary").alias("category"),
        F.col("pfc_detailed").alias("subcategory"),
        F.col("clean_merchant_name").alias("counterparty"),
        "payment_channel",
        F.lit("plaid").alias("source_system"),
        F.lit("bank_transaction").alias("cash_flow_type"),
    )
    n = F.col("net_amount")
    stripe = stripe_bt.filter(F.col("transaction_type").isin("payout", "charge", "refund")).select(
        F.col("balance_transaction_id").alias("cash_flow_id"),
        null_of("string").alias("bank_account_id"),
        F.to_date("created_at").alias("cash_flow_date"),
        n.cast(AMT).alias("amount"),
        "currency_code",
        *split(n),
        F.col("transaction_type").alias("category"),
        null_of("string").alias("subcategory"),
        F.lit("Stripe").alias("counterparty"),
        F.lit("electronic").alias("payment_channel"),
        F.lit("stripe").alias("source_system"),
        F.lit("payment_processor").alias("cash_flow_type"),
    )
    c = bank.select(*CASH_COLUMNS).unionByName(stripe.select(*CASH_COLUMNS))
    b = balances.select(
        F.col("plaid_account_id").alias("_acct"),
        F.col("balance_date").cast("string").alias("_bdate"),
        F.col("current_balance").alias("eod_balance"),
        F.col("available_balance").alias("eod_available_balance"),
    )
    c = c.withColumn("_cdate", F.col("cash_flow_date").cast("string"))
    # Stripe rows carry no bank account: spread them, they never match
    j = left_join_spread(c, b, [("bank_account_id", "_acct"), ("_cdate", "_bdate")], spread_col="cash_flow_id")
    d = F.col("cash_flow_date")
    return j.select(
        "cash_flow_id", "bank_account_id", "cash_flow_date", "amount", "currency_code", "inflow_amount",
        "outflow_amount",
        (F.col("inflow_amount") - F.col("outflow_amount")).cast(AMT).alias("net_cash_flow"),
        "category", "subcategory", "counterparty", "payment_channel", "source_system", "cash_flow_type",
        "eod_balance", "eod_available_balance",
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofweek(d).alias("day_of_week"),
        lit_ts(p.run_ts).alias("_loaded_at"),
    )


# ---------------------------------------------------------------------------
# M29 fct_accounts_receivable
# ---------------------------------------------------------------------------
AGING = [  # (bucket label, sort order, low, high) for days past due
    ("1-30 Days", 2, 1, 30),
    ("31-60 Days", 3, 31, 60),
    ("61-90 Days", 4, 61, 90),
]


def aging_bucket(balance, due, as_of):
    """(label, sort) columns: Paid, Current, 1-30, 31-60, 61-90, 90+ Days.

    A NULL due date or NULL balance falls through to '90+ Days' (D16).
    """
    dpd = F.datediff(as_of, due)
    label = F.when(balance == 0, "Paid").when(due >= as_of, "Current")
    sort = F.when(balance == 0, 0).when(due >= as_of, 1)
    for name, order, lo, hi in AGING:
        label = label.when(dpd.between(lo, hi), name)
        sort = sort.when(dpd.between(lo, hi), order)
    return label.otherwise("90+ Days"), sort.otherwise(5)


def fct_accounts_receivable(invoices: DataFrame, golden: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    gc = golden.filter(F.col("quickbooks_customer_id").isNotNull()).select(
        F.col("customer_golden_id").alias("customer_key"), F.col("quickbooks_customer_id").alias("_qb")
    )
    j = left_join_spread(invoices, gc, [("customer_id", "_qb")], spread_col="invoice_id")
    as_of = lit_date(p.as_of)
    label, sort = aging_bucket(F.col("balance_due"), F.col("due_date"), as_of)
    return j.select(
        "invoice_id", "customer_key", "invoice_number", "invoice_date", "due_date", "total_amount", "balance_due",
        (F.col("total_amount") - F.col("balance_due")).cast("decimal(18,4)").alias("amount_paid"),
        "payment_status", "currency_code",
        day_diff(as_of, "due_date").alias("days_past_due"),
        label.alias("aging_bucket"),
        sort.alias("aging_bucket_sort"),
        "source_system",
        lit_ts(p.run_ts).alias("_loaded_at"),
    )


def ar_aging_summary(ar: DataFrame) -> DataFrame:
    """AR total per bucket (the minimum slice of the build plan)."""
    return ar.groupBy("aging_bucket", "aging_bucket_sort").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        F.sum("total_amount").cast("decimal(28,4)").alias("total_amount"),
        F.sum("balance_due").cast("decimal(28,4)").alias("balance_due"),
    )


# ---------------------------------------------------------------------------
# M30 dim_customers
# ---------------------------------------------------------------------------
# The source systems of the spine
SOURCE_BITS = ("quickbooks", "stripe", "netsuite", "plaid", "salesforce")


def source_bit(col: str):
    """The bit of a source system; NULL for none."""
    bit = F.when(F.col(col).isNull(), F.lit(None).cast("int"))
    for i, name in enumerate(SOURCE_BITS):
        bit = bit.when(F.col(col) == name, F.lit(1 << i))
    return bit.otherwise(F.raise_error(F.concat(F.lit("unknown source system: "), F.col(col))).cast("int"))


def repeats(df: DataFrame, cols: list[str]) -> bool:
    """Whether a combination of ``cols`` may occur twice: eight bytes a row are
    shuffled; two combinations with one hash only count as a repeat."""
    return not df.groupBy(F.xxhash64(*cols).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def customer_metrics(fct: DataFrame, one_row_each: bool | None = None) -> DataFrame:
    """A2 + A3: per-customer lifetime metrics with two exact distinct counts.

    The sources are a few fixed systems, so the distinct ones of a customer are
    the bits of a mask. Where every transaction of a customer is one row, which
    is checked unless ``one_row_each`` says it, counting rows counts
    transactions: one shuffle on the customer, combined before it, so a
    customer with a third of all rows sends one row per task. Otherwise rows
    are grouped by (customer, transaction) first. A row without a transaction
    key counts as no transaction; a source outside ``SOURCE_BITS`` is an error,
    never left uncounted.
    """
    rows = fct.filter(F.col("customer_key").isNotNull()).withColumn("_source", source_bit("source_system"))
    if one_row_each is None:
        one_row_each = not repeats(rows, ["customer_key", "transaction_key"])
    first = last = "transaction_date"
    if not one_row_each:
        rows = rows.groupBy("customer_key", "transaction_key").agg(
            F.sum("amount").alias("amount"), F.sum("revenue_amount").alias("revenue_amount"),
            F.min("transaction_date").alias("_first"), F.max("transaction_date").alias("_last"),
            F.bit_or("_source").alias("_source"))
        first, last = "_first", "_last"
    return rows.groupBy("customer_key").agg(
        F.count("transaction_key").alias("lifetime_transaction_count"),
        F.sum("amount").cast(AMT).alias("lifetime_transaction_value"),
        F.sum("revenue_amount").cast(AMT).alias("lifetime_revenue"),
        F.min(first).alias("first_transaction_date"),
        F.max(last).alias("last_transaction_date"),
        F.bit_count(F.coalesce(F.bit_or("_source"), F.lit(0))).cast("bigint").alias("source_system_count"),
    )


TIERS = [("Enterprise", 100000), ("Mid-Market", 25000), ("SMB", 5000)]


def customer_tier(rev):
    t = F.when(rev >= TIERS[0][1], TIERS[0][0])
    for name, lo in TIERS[1:]:
        t = t.when(rev >= lo, name)
    return t.when(rev > 0, "Starter").otherwise("Prospect")


def dim_customers(golden: DataFrame, fct: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    tm = customer_metrics(fct)
    j = golden.join(tm, golden.customer_golden_id == tm.customer_key, "left").drop(tm.customer_key)
    rev = F.coalesce(F.col("lifetime_revenue"), F.lit(0).cast(AMT))
    return j.select(
        F.col("customer_golden_id").alias("customer_key"),
        "stripe_customer_id", "quickbooks_customer_id", "netsuite_customer_id", "salesforce_account_id",
        "company_name", "first_name", "last_name", "email", "phone", "website",
        "billing_address", "billing_city", "billing_state", "billing_postal_code", "billing_country",
        "industry", "customer_segment", "annual_revenue", "employee_count",
        "is_active_accounting", "is_delinquent", "is_multi_source_match", "primary_source",
        F.coalesce("lifetime_transaction_count", F.lit(0).cast("bigint")).alias("lifetime_transaction_count"),
        F.coalesce("lifetime_transaction_value", F.lit(0).cast(AMT)).alias("lifetime_transaction_value"),
        rev.alias("lifetime_revenue"),
        "first_transaction_date", "last_transaction_date", "source_system_count",
        customer_tier(rev).alias("customer_tier"),
        "first_seen_at", "updated_at",
        lit_ts(p.run_ts).alias("_dim_updated_at"),
    )


# ---------------------------------------------------------------------------
# M31 dim_accounts, M32 dim_date
# ---------------------------------------------------------------------------
def dim_accounts(coa: DataFrame) -> DataFrame:
    return coa.select(
        F.col("account_golden_id").alias("account_key"),
        "source_account_id", "source_system", "account_name", "account_number", "account_type",
        "account_sub_type", "classification", "category", "financial_statement_line", "is_balance_sheet",
        "is_income_statement", "is_active",
        F.col("_golden_record_updated_at").alias("_dim_updated_at"),
    )


def dim_date(spark, p: RunParams = DEFAULT, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    d = F.col("date_day")
    as_of = lit_date(p.as_of)
    return date_spine(spark, start, end).select(
        d.alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        week_of_year_sunday(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.year(d).alias("fiscal_year"),
        F.quarter(d).alias("fiscal_quarter"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == as_of).alias("is_today"),
        day_diff(as_of, d).alias("days_ago"),
        month_boundaries(as_of, d).alias("months_ago"),
    )
