"""Staging jobs M1-M13: typed, renamed projections of the raw tables.

Each function takes the raw DataFrame and returns the staged one. They are
narrow (no shuffle); filters on raw booleans are written against the raw
column so Catalyst pushes them into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import (
    BASE,
    MONEY,
    PROB,
    RATE,
    cents_to_dollars,
    currency_code,
    json_scalar,
    json_scalars,
    json_string_array_path,
    lit_date,
)
from ledgerlake.params import DEFAULT, RunParams

S = "string"


def _ts(c: str):
    """ISO-8601 text -> timestamp (UTC session)."""
    return F.to_timestamp(F.col(c))


def _loaded_at():
    """Landing stamp; landed JSON carries it as ISO-8601 text."""
    return F.col("_loaded_at").cast("timestamp").alias("_loaded_at")


# ---------------------------------------------------------------------------
# QuickBooks
# ---------------------------------------------------------------------------
def stg_quickbooks_accounts(raw: DataFrame) -> DataFrame:  # M1
    return raw.select(
        F.col("id").cast(S).alias("account_id"),
        F.col("name").cast(S).alias("account_name"),
        F.col("account_type").cast(S).alias("account_type"),
        F.col("account_sub_type").cast(S).alias("account_sub_type"),
        F.col("acct_num").cast(S).alias("account_number"),
        F.col("classification").cast(S).alias("classification"),
        F.col("current_balance").cast(MONEY).alias("current_balance"),
        currency_code("currency_ref_value").alias("currency_code"),
        F.col("active").cast("boolean").alias("is_active"),
        _ts("meta_create_time").alias("created_at"),
        _ts("meta_last_updated_time").alias("updated_at"),
        _loaded_at(),
        F.lit("quickbooks").alias("source_system"),
    )


def stg_quickbooks_customers(raw: DataFrame) -> DataFrame:  # M2
    return raw.select(
        F.col("id").cast(S).alias("customer_id"),
        F.col("display_name").cast(S).alias("display_name"),
        F.col("company_name").cast(S).alias("company_name"),
        F.col("given_name").cast(S).alias("first_name"),
        F.col("family_name").cast(S).alias("last_name"),
        F.col("primary_email_addr_address").cast(S).alias("email"),
        F.col("primary_phone_free_form_number").cast(S).alias("phone"),
        F.col("bill_addr_line1").cast(S).alias("billing_address_line1"),
        F.col("bill_addr_city").cast(S).alias("billing_city"),
        F.col("bill_addr_country_sub_division_code").cast(S).alias("billing_state"),
        F.col("bill_addr_postal_code").cast(S).alias("billing_postal_code"),
        F.col("bill_addr_country").cast(S).alias("billing_country"),
        F.col("active").cast("boolean").alias("is_active"),
        F.col("balance").cast(MONEY).alias("outstanding_balance"),
        currency_code("currency_ref_value").alias("currency_code"),
        _ts("meta_create_time").alias("created_at"),
        _ts("meta_last_updated_time").alias("updated_at"),
        _loaded_at(),
        F.lit("quickbooks").alias("source_system"),
    )


def stg_quickbooks_invoices(raw: DataFrame, p: RunParams = DEFAULT) -> DataFrame:  # M3
    status = (
        F.when(F.col("balance") == 0, "paid")
        .when(F.col("due_date") < lit_date(p.as_of), "overdue")
        .otherwise("open")
    )
    return raw.select(
        F.col("id").cast(S).alias("invoice_id"),
        F.col("customer_ref_value").cast(S).alias("customer_id"),
        F.col("doc_number").cast(S).alias("invoice_number"),
        F.col("total_amt").cast(MONEY).alias("total_amount"),
        F.col("balance").cast(MONEY).alias("balance_due"),
        currency_code("currency_ref_value").alias("currency_code"),
        F.col("txn_date").cast("date").alias("invoice_date"),
        F.col("due_date").cast("date").alias("due_date"),
        F.col("email_status").cast(S).alias("email_status"),
        status.alias("payment_status"),
        _ts("meta_create_time").alias("created_at"),
        _ts("meta_last_updated_time").alias("updated_at"),
        _loaded_at(),
        F.lit("quickbooks").alias("source_system"),
    )


def stg_quickbooks_payments(raw: DataFrame) -> DataFrame:  # M4
    return raw.select(
        F.col("id").cast(S).alias("payment_id"),
        F.col("customer_ref_value").cast(S).alias("customer_id"),
        F.col("total_amt").cast(MONEY).alias("payment_amount"),
        currency_code("currency_ref_value").alias("currency_code"),
        F.col("txn_date").cast("date").alias("payment_date"),
        F.col("deposit_to_account_ref_value").cast(S).alias("deposit_account_id"),
        F.coalesce(F.col("payment_method_ref_value").cast(S), F.lit("unknown")).alias("payment_method"),
        _ts("meta_create_time").alias("created_at"),
        _ts("meta_last_updated_time").alias("updated_at"),
        _loaded_at(),
        F.lit("quickbooks").alias("source_system"),
    )


# ---------------------------------------------------------------------------
# Stripe
# ---------------------------------------------------------------------------
def stg_stripe_charges(raw: DataFrame) -> DataFrame:  # M5
    meta = json_scalars("metadata", ["order_id", "customer_email"])
    return raw.select(
        F.col("id").cast(S).alias("charge_id"),
        F.col("customer").cast(S).alias("stripe_customer_id"),
        cents_to_dollars("amount").alias("charge_amount"),
        cents_to_dollars("amount_refunded").alias("refunded_amount"),
        F.upper("currency").alias("currency_code"),
        F.col("status").cast(S).alias("charge_status"),
        F.col("paid").cast("boolean").alias("is_paid"),
        F.col("refunded").cast("boolean").alias("is_refunded"),
        F.col("disputed").cast("boolean").alias("is_disputed"),
        F.col("payment_method").cast(S).alias("payment_method_id"),
        json_scalar("payment_method_details", "$.type").alias("payment_method_type"),
        F.col("description").cast(S).alias("description"),
        F.col("invoice").cast(S).alias("stripe_invoice_id"),
        meta["order_id"].alias("external_order_id"),
        meta["customer_email"].alias("customer_email"),
        F.timestamp_seconds(F.col("created").cast("bigint")).alias("created_at"),
        _loaded_at(),
        F.lit("stripe").alias("source_system"),
    )


def stg_stripe_customers(raw: DataFrame) -> DataFrame:  # M6
    addr = json_scalars("address", ["line1", "city", "state", "postal_code", "country"])
    meta = json_scalars("metadata", ["qb_customer_id", "ns_customer_id", "sf_account_id"])
    return raw.select(
        F.col("id").cast(S).alias("stripe_customer_id"),
        F.col("name").cast(S).alias("customer_name"),
        F.col("email").cast(S).alias("email"),
        F.col("phone").cast(S).alias("phone"),
        addr["line1"].alias("address_line1"),
        addr["city"].alias("city"),
        addr["state"].alias("state"),
        addr["postal_code"].alias("postal_code"),
        addr["country"].alias("country"),
        F.upper(F.coalesce(F.col("currency"), F.lit("USD"))).alias("currency_code"),
        F.col("delinquent").cast("boolean").alias("is_delinquent"),
        meta["qb_customer_id"].alias("quickbooks_customer_id"),
        meta["ns_customer_id"].alias("netsuite_customer_id"),
        meta["sf_account_id"].alias("salesforce_account_id"),
        F.timestamp_seconds(F.col("created").cast("bigint")).alias("created_at"),
        _loaded_at(),
        F.lit("stripe").alias("source_system"),
    )


def stg_stripe_balance_transactions(raw: DataFrame) -> DataFrame:  # M7
    return raw.select(
        F.col("id").cast(S).alias("balance_transaction_id"),
        cents_to_dollars("amount").alias("amount"),
        cents_to_dollars("fee").alias("fee_amount"),
        cents_to_dollars("net").alias("net_amount"),
        F.upper("currency").alias("currency_code"),
        F.col("type").cast(S).alias("transaction_type"),
        F.col("status").cast(S).alias("transaction_status"),
        F.col("source").cast(S).alias("source_id"),
        F.col("description").cast(S).alias("description"),
        F.timestamp_seconds(F.col("created").cast("bigint")).alias("created_at"),
        F.timestamp_seconds(F.col("available_on").cast("bigint")).alias("available_on"),
        _loaded_at(),
        F.lit("stripe").alias("source_system"),
    )


# ---------------------------------------------------------------------------
# NetSuite
# ---------------------------------------------------------------------------
# NetSuite account type -> classification (anything else 'Other')
NETSUITE_CLASSIFICATION = {
    "Bank": "Asset",
    "AcctRec": "Asset",
    "OthCurrAsset": "Asset",
    "FixedAsset": "Asset",
    "OthAsset": "Asset",
    "AcctPay": "Liability",
    "CreditCard": "Liability",
    "OthCurrLiab": "Liability",
    "LongTermLiab": "Liability",
    "Equity": "Equity",
    "Income": "Revenue",
    "OthIncome": "Revenue",
    "Expense": "Expense",
    "OthExpense": "Expense",
    "COGS": "Expense",
}


def stg_netsuite_transactions(raw: DataFrame) -> DataFrame:  # M8
    total = F.col("total").cast(MONEY)
    rate = F.col("exchange_rate").cast(RATE)
    # filter on the raw boolean so it is pushed to the scan; NULL drops too
    return raw.filter(F.col("voided") == F.lit(False)).select(
        F.col("id").cast(S).alias("transaction_id"),
        F.col("tran_id").cast(S).alias("transaction_number"),
        F.col("type").cast(S).alias("transaction_type"),
        F.col("status").cast(S).alias("transaction_status"),
        F.col("entity").cast(S).alias("entity_id"),
        F.col("subsidiary").cast(S).alias("subsidiary_id"),
        F.col("department").cast(S).alias("department_id"),
        F.col("currency").cast(S).alias("currency_id"),
        rate.alias("exchange_rate"),
        total.alias("total_amount"),
        (total * rate).cast(BASE).alias("total_amount_base"),
        F.col("tran_date").cast("date").alias("transaction_date"),
        F.col("due_date").cast("date").alias("due_date"),
        F.col("posting").cast("boolean").alias("is_posting"),
        F.col("voided").cast("boolean").alias("is_voided"),
        F.col("memo").cast(S).alias("memo"),
        _ts("date_created").alias("created_at"),
        _ts("last_modified_date").alias("updated_at"),
        _loaded_at(),
        F.lit("netsuite").alias("source_system"),
    )


def stg_netsuite_accounts(raw: DataFrame) -> DataFrame:  # M9
    t = F.col("acct_type").cast(S)
    cls = F.lit("Other")
    for k, v in reversed(list(NETSUITE_CLASSIFICATION.items())):
        cls = F.when(t == k, v).otherwise(cls)
    return raw.select(
        F.col("id").cast(S).alias("account_id"),
        F.col("acct_name").cast(S).alias("account_name"),
        F.col("acct_number").cast(S).alias("account_number"),
        t.alias("account_type"),
        F.col("general_rate_type").cast(S).alias("rate_type"),
        F.col("parent").cast(S).alias("parent_account_id"),
        F.col("is_inactive").cast("boolean").alias("is_inactive"),
        (~F.col("is_inactive").cast("boolean")).alias("is_active"),
        cls.alias("classification"),
        _loaded_at(),
        F.lit("netsuite").alias("source_system"),
    )


# ---------------------------------------------------------------------------
# Plaid
# ---------------------------------------------------------------------------
def stg_plaid_transactions(raw: DataFrame) -> DataFrame:  # M10
    amt = F.col("amount").cast(MONEY)
    pfc = json_scalars("personal_finance_category", ["primary", "detailed"])
    return raw.filter(F.col("pending") == F.lit(False)).select(
        F.col("transaction_id").cast(S).alias("plaid_transaction_id"),
        F.col("account_id").cast(S).alias("plaid_account_id"),
        # Plaid reports outflows as positive; flip to the accounting sign
        (amt * -1).cast(MONEY).alias("amount"),
        F.upper("iso_currency_code").alias("currency_code"),
        F.col("date").cast("date").alias("transaction_date"),
        F.col("authorized_date").cast("date").alias("authorized_date"),
        F.col("name").cast(S).alias("merchant_name"),
        F.col("merchant_name").cast(S).alias("clean_merchant_name"),
        F.col("payment_channel").cast(S).alias("payment_channel"),
        F.col("pending").cast("boolean").alias("is_pending"),
        F.col("category_id").cast(S).alias("plaid_category_id"),
        json_string_array_path("category", " > ").alias("category_hierarchy"),
        pfc["primary"].alias("pfc_primary"),
        pfc["detailed"].alias("pfc_detailed"),
        # direction from the raw (un-flipped) sign
        F.when(amt > 0, "outflow").when(amt < 0, "inflow").otherwise("zero").alias("flow_direction"),
        _loaded_at(),
        F.lit("plaid").alias("source_system"),
    )


def stg_plaid_balances(raw: DataFrame) -> DataFrame:  # M11
    return raw.select(
        F.col("account_id").cast(S).alias("plaid_account_id"),
        F.col("current").cast(MONEY).alias("current_balance"),
        F.col("available").cast(MONEY).alias("available_balance"),
        F.col("limit").cast(MONEY).alias("credit_limit"),
        F.upper("iso_currency_code").alias("currency_code"),
        F.col("snapshot_date").cast("date").alias("balance_date"),
        _loaded_at(),
        F.lit("plaid").alias("source_system"),
    )


# ---------------------------------------------------------------------------
# Salesforce
# ---------------------------------------------------------------------------
def stg_salesforce_accounts(raw: DataFrame) -> DataFrame:  # M12
    return raw.filter(F.col("is_deleted") == F.lit(False)).select(
        F.col("id").cast(S).alias("sf_account_id"),
        F.col("name").cast(S).alias("company_name"),
        F.col("type").cast(S).alias("account_type"),
        F.col("industry").cast(S).alias("industry"),
        F.col("annual_revenue").cast(MONEY).alias("annual_revenue"),
        F.col("number_of_employees").cast("bigint").alias("employee_count"),
        F.col("billing_street").cast(S).alias("billing_street"),
        F.col("billing_city").cast(S).alias("billing_city"),
        F.col("billing_state").cast(S).alias("billing_state"),
        F.col("billing_postal_code").cast(S).alias("billing_postal_code"),
        F.col("billing_country").cast(S).alias("billing_country"),
        F.col("phone").cast(S).alias("phone"),
        F.col("website").cast(S).alias("website"),
        F.col("owner_id").cast(S).alias("owner_id"),
        _ts("created_date").alias("created_at"),
        _ts("last_modified_date").alias("updated_at"),
        _loaded_at(),
        F.lit("salesforce").alias("source_system"),
    )


def stg_salesforce_opportunities(raw: DataFrame) -> DataFrame:  # M13
    return raw.filter(F.col("is_deleted") == F.lit(False)).select(
        F.col("id").cast(S).alias("opportunity_id"),
        F.col("account_id").cast(S).alias("sf_account_id"),
        F.col("name").cast(S).alias("opportunity_name"),
        F.col("stage_name").cast(S).alias("stage"),
        F.col("amount").cast(MONEY).alias("amount"),
        F.upper(F.coalesce(F.col("currency_iso_code").cast(S), F.lit("USD"))).alias("currency_code"),
        (F.col("probability").cast(MONEY) / 100).cast(PROB).alias("probability"),
        F.col("close_date").cast("date").alias("close_date"),
        F.col("type").cast(S).alias("opportunity_type"),
        F.col("is_won").cast("boolean").alias("is_won"),
        F.col("is_closed").cast("boolean").alias("is_closed"),
        F.col("fiscal_year").cast("bigint").alias("fiscal_year"),
        F.col("fiscal_quarter").cast("bigint").alias("fiscal_quarter"),
        F.col("owner_id").cast(S).alias("owner_id"),
        _ts("created_date").alias("created_at"),
        _ts("last_modified_date").alias("updated_at"),
        _loaded_at(),
        F.lit("salesforce").alias("source_system"),
    )


def _memo(fn):
    """Build a staged frame once per Staging object (lazy plan, no data)."""
    name = fn.__name__

    def wrapper(self):
        if name not in self._frames:
            self._frames[name] = fn(self)
        return self._frames[name]

    wrapper.__name__ = name
    wrapper.__doc__ = fn.__doc__
    return wrapper


class Staging:
    """Staged views over a raw-table accessor ``raw(name) -> DataFrame``."""

    def __init__(self, raw, params: RunParams = DEFAULT):
        self.raw, self.params = raw, params
        self._frames: dict[str, DataFrame] = {}

    @_memo
    def qb_accounts(self):
        return stg_quickbooks_accounts(self.raw("quickbooks.accounts"))

    @_memo
    def qb_customers(self):
        return stg_quickbooks_customers(self.raw("quickbooks.customers"))

    @_memo
    def qb_invoices(self):
        return stg_quickbooks_invoices(self.raw("quickbooks.invoices"), self.params)

    @_memo
    def qb_payments(self):
        return stg_quickbooks_payments(self.raw("quickbooks.payments"))

    @_memo
    def stripe_charges(self):
        return stg_stripe_charges(self.raw("stripe.charges"))

    @_memo
    def stripe_customers(self):
        return stg_stripe_customers(self.raw("stripe.customers"))

    @_memo
    def stripe_balance_transactions(self):
        return stg_stripe_balance_transactions(self.raw("stripe.balance_transactions"))

    @_memo
    def ns_transactions(self):
        return stg_netsuite_transactions(self.raw("netsuite.transactions"))

    @_memo
    def ns_accounts(self):
        return stg_netsuite_accounts(self.raw("netsuite.accounts"))

    @_memo
    def plaid_transactions(self):
        return stg_plaid_transactions(self.raw("plaid.transactions"))

    @_memo
    def plaid_balances(self):
        return stg_plaid_balances(self.raw("plaid.balances"))

    @_memo
    def sf_accounts(self):
        return stg_salesforce_accounts(self.raw("salesforce.accounts"))

    @_memo
    def sf_opportunities(self):
        return stg_salesforce_opportunities(self.raw("salesforce.opportunities"))
