"""Intermediate jobs: golden customers (M14), unified transactions (M15),
unified chart of accounts (M16)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import BASE, lit_ts, null_of, split_part, surrogate_key
from ledgerlake.operators.joins import left_join_spread, not_in
from ledgerlake.params import DEFAULT, RunParams

HIGH_TS = "2099-01-01 00:00:00"
LOW_TS = "2000-01-01 00:00:00"


# ---------------------------------------------------------------------------
# M14 golden customers
# ---------------------------------------------------------------------------
def golden_mappings(
    stripe: DataFrame, qb: DataFrame, match_blank_emails: bool = True
) -> DataFrame:
    """Cross-reference rows: Stripe metadata ids UNION ALL QB email matches.

    Stripe attributes are carried on every mapping row (each row comes from
    exactly one Stripe customer), which saves re-joining Stripe by id later.
    """
    sc_cols = [
        "stripe_customer_id", "quickbooks_customer_id", "netsuite_customer_id",
        "salesforce_account_id", "customer_name", "email", "phone", "address_line1",
        "city", "state", "postal_code", "country", "is_delinquent", "created_at",
    ]
    sc = stripe.filter(F.col("stripe_customer_id").isNotNull()).select(*sc_cols)
    cross_ref = sc.withColumn("_qb_from_email", F.lit(False))

    # QB customers that no Stripe metadata references (NOT IN, NULL-safe)
    qb_unref = not_in(
        qb.filter(F.col("email").isNotNull()).select("customer_id", "email"),
        "customer_id",
        cross_ref,
        "quickbooks_customer_id",
    )
    qkey = F.lower(F.trim(F.col("email")))
    qb_keyed = qb_unref.select(F.col("customer_id").alias("_qb_id"), qkey.alias("_ekey"))
    sc_keyed = sc.filter(F.col("email").isNotNull()).withColumn("_ekey", F.lower(F.trim(F.col("email"))))
    if not match_blank_emails:
        # an empty address is not an identity; matching it would pair every
        # blank-email QB customer with every blank-email Stripe customer
        qb_keyed = qb_keyed.filter(F.col("_ekey") != "")
        sc_keyed = sc_keyed.filter(F.col("_ekey") != "")
    email_match = (
        qb_keyed.join(sc_keyed, "_ekey", "inner")
        .withColumn("quickbooks_customer_id", F.col("_qb_id"))
        .drop("_qb_id", "_ekey")
        .withColumn("_qb_from_email", F.lit(True))
    )
    return cross_ref.unionByName(email_match.select(*cross_ref.columns))


def golden_customers(
    stripe: DataFrame,
    qb: DataFrame,
    sf: DataFrame,
    p: RunParams = DEFAULT,
    match_blank_emails: bool = True,
) -> DataFrame:
    m = golden_mappings(stripe, qb, match_blank_emails)
    gid = surrogate_key(
        F.coalesce("salesforce_account_id", F.lit("")),
        F.coalesce("netsuite_customer_id", F.lit("")),
        F.coalesce("quickbooks_customer_id", F.lit("")),
        F.coalesce("stripe_customer_id", F.lit("")),
    )
    sc = m.select(
        gid.alias("customer_golden_id"),
        "stripe_customer_id", "quickbooks_customer_id", "netsuite_customer_id", "salesforce_account_id",
        *[F.col(c).alias(f"sc_{c}") for c in [
            "customer_name", "email", "phone", "address_line1", "city", "state",
            "postal_code", "country", "is_delinquent", "created_at",
        ]],
    )
    qbp = qb.select(*[F.col(c).alias(f"qb_{c}") for c in [
        "customer_id", "company_name", "first_name", "last_name", "email", "phone",
        "billing_address_line1", "billing_city", "billing_state", "billing_postal_code",
        "billing_country", "is_active", "created_at", "updated_at",
    ]])
    sfp = sf.select(*[F.col(c).alias(f"sf_{c}") for c in [
        "sf_account_id", "company_name", "phone", "website", "billing_street", "billing_city",
        "billing_state", "billing_postal_code", "billing_country", "industry", "annual_revenue",
        "employee_count", "account_type", "created_at", "updated_at",
    ]])
    # most mapping rows lack a QuickBooks or Salesforce id: spread those rows
    # instead of sending every NULL key to one reducer
    j = left_join_spread(sc, qbp, [("quickbooks_customer_id", "qb_customer_id")], spread_col="stripe_customer_id")
    j = left_join_spread(j, sfp, [("salesforce_account_id", "sf_sf_account_id")], spread_col="stripe_customer_id")
    hi, lo = lit_ts(HIGH_TS), lit_ts(LOW_TS)
    c = F.col
    return j.select(
        "customer_golden_id",
        "stripe_customer_id", "quickbooks_customer_id", "netsuite_customer_id", "salesforce_account_id",
        F.coalesce(c("sf_company_name"), c("qb_company_name"), c("sc_customer_name")).alias("company_name"),
        F.coalesce(c("qb_first_name"), split_part("sc_customer_name", " ", 0)).alias("first_name"),
        F.coalesce(c("qb_last_name"), split_part("sc_customer_name", " ", 1)).alias("last_name"),
        F.coalesce(F.lower(F.trim(c("qb_email"))), F.lower(F.trim(c("sc_email")))).alias("email"),
        F.coalesce(c("qb_phone"), c("sf_phone"), c("sc_phone")).alias("phone"),
        c("sf_website").alias("website"),
        F.coalesce(c("sf_billing_street"), c("qb_billing_address_line1"), c("sc_address_line1")).alias("billing_address"),
        F.coalesce(c("sf_billing_city"), c("qb_billing_city"), c("sc_city")).alias("billing_city"),
        F.coalesce(c("sf_billing_state"), c("qb_billing_state"), c("sc_state")).alias("billing_state"),
        F.coalesce(c("sf_billing_postal_code"), c("qb_billing_postal_code"), c("sc_postal_code")).alias("billing_postal_code"),
        F.coalesce(c("sf_billing_country"), c("qb_billing_country"), c("sc_country")).alias("billing_country"),
        c("sf_industry").alias("industry"),
        c("sf_annual_revenue").alias("annual_revenue"),
        c("sf_employee_count").alias("employee_count"),
        c("sf_account_type").alias("customer_segment"),
        F.coalesce(c("qb_is_active"), F.lit(True)).alias("is_active_accounting"),
        F.coalesce(c("sc_is_delinquent"), F.lit(False)).alias("is_delinquent"),
        F.least(
            F.coalesce(c("sf_created_at"), hi), F.coalesce(c("qb_created_at"), hi), F.coalesce(c("sc_created_at"), hi)
        ).alias("first_seen_at"),
        F.greatest(
            F.coalesce(c("sf_updated_at"), lo), F.coalesce(c("qb_updated_at"), lo), F.coalesce(c("sc_created_at"), lo)
        ).alias("updated_at"),
        F.when(c("sf_sf_account_id").isNotNull(), "salesforce")
        .when(c("qb_customer_id").isNotNull(), "quickbooks")
        .when(c("stripe_customer_id").isNotNull(), "stripe")
        .alias("primary_source"),
        (c("sf_sf_account_id").isNotNull() & (c("qb_customer_id").isNotNull() | c("stripe_customer_id").isNotNull())).alias(
            "is_multi_source_match"
        ),
        lit_ts(p.run_ts).alias("_golden_record_updated_at"),
    )


# ---------------------------------------------------------------------------
# M15 unified transactions
# ---------------------------------------------------------------------------
UTX_COLUMNS = [
    "transaction_unified_id", "source_transaction_id", "transaction_type", "transaction_category",
    "source_entity_id", "entity_type", "amount", "currency_code", "transaction_date", "status",
    "reference_number", "memo", "created_at", "source_system", "_unified_at", "_loaded_at",
]


def _feed(df: DataFrame, **cols) -> DataFrame:
    return df.select(*[(v if not isinstance(v, str) else F.col(v)).alias(k) for k, v in cols.items()])


def utx_feeds(stg, p: RunParams = DEFAULT) -> dict[str, DataFrame]:
    """The five source feeds of the unified spine, keyed by source system
    (QuickBooks has two feeds, so its value is their union), before ``with_ids``."""
    lit = F.lit
    s = "string"
    qb_inv = _feed(
        stg.qb_invoices(),
        _id_kind=lit("qb_invoice"),
        source_transaction_id="invoice_id",
        transaction_type=lit("invoice"),
        transaction_category=lit("accounts_receivable"),
        source_entity_id="customer_id",
        entity_type=lit("customer"),
        amount=F.col("total_amount").cast(BASE),
        currency_code="currency_code",
        transaction_date="invoice_date",
        status="payment_status",
        reference_number="invoice_number",
        memo=null_of(s),
        created_at="created_at",
        source_system="source_system",
        _loaded_at="_loaded_at",
    )
    qb_pay = _feed(
        stg.qb_payments(),
        _id_kind=lit("qb_payment"),
        source_transaction_id="payment_id",
        transaction_type=lit("payment_received"),
        transaction_category=lit("cash_receipt"),
        source_entity_id="customer_id",
        entity_type=lit("customer"),
        amount=F.col("payment_amount").cast(BASE),
        currency_code="currency_code",
        transaction_date="payment_date",
        status=lit("completed"),
        reference_number=null_of(s),
        memo=null_of(s),
        created_at="created_at",
        source_system="source_system",
        _loaded_at="_loaded_at",
    )
    charges = _feed(
        stg.stripe_charges().filter(F.col("is_paid") == True),  # noqa: E712
        _id_kind=lit("stripe_charge"),
        source_transaction_id="charge_id",
        transaction_type=lit("payment_received"),
        transaction_category=lit("cash_receipt"),
        source_entity_id="stripe_customer_id",
        entity_type=lit("customer"),
        amount=F.col("charge_amount").cast(BASE),
        currency_code="currency_code",
        transaction_date=F.to_date("created_at"),
        status="charge_status",
        reference_number="external_order_id",
        memo="description",
        created_at="created_at",
        source_system="source_system",
        _loaded_at="_loaded_at",
    )
    tt = F.col("transaction_type")
    ns = _feed(
        stg.ns_transactions().filter(F.col("is_posting") == True),  # noqa: E712
        _id_kind=lit("ns_txn"),
        source_transaction_id="transaction_id",
        transaction_type="transaction_type",
        transaction_category=F.when(tt.isin("CustInvc", "CustCred"), "accounts_receivable")
        .when(tt.isin("VendBill", "VendCred"), "accounts_payable")
        .when(tt == "Journal", "journal_entry")
        .when(tt.isin("CustPymt", "VendPymt"), "cash_receipt")
        .otherwise("other"),
        source_entity_id="entity_id",
        entity_type=F.when(tt.like("Cust%"), "customer").when(tt.like("Vend%"), "vendor").otherwise("other"),
        amount=F.col("total_amount_base").cast(BASE),
        currency_code=lit("USD"),
        transaction_date="transaction_date",
        status="transaction_status",
        reference_number="transaction_number",
        memo="memo",
        created_at="created_at",
        source_system="source_system",
        _loaded_at="_loaded_at",
    )
    fd = F.col("flow_direction")
    plaid = _feed(
        stg.plaid_transactions(),
        _id_kind=lit("plaid_txn"),
        source_transaction_id="plaid_transaction_id",
        transaction_type=lit("bank_transaction"),
        transaction_category=F.when(fd == "inflow", "cash_receipt").when(fd == "outflow", "cash_disbursement").otherwise("other"),
        source_entity_id="plaid_account_id",
        entity_type=lit("bank_account"),
        amount=F.col("amount").cast(BASE),
        currency_code="currency_code",
        transaction_date="transaction_date",
        status=lit("posted"),
        reference_number=null_of(s),
        memo="merchant_name",
        created_at="_loaded_at",
        source_system="source_system",
        _loaded_at="_loaded_at",
    )
    return {"quickbooks": qb_inv.unionByName(qb_pay), "stripe": charges, "netsuite": ns, "plaid": plaid}


def spine_rows(stg, p: RunParams = DEFAULT, watermarks: dict | None = None) -> DataFrame:
    """The spine's rows without the columns that ``with_ids`` makes from the
    others: what a job shuffles, a third narrower than the whole rows.

    ``watermarks`` = {source_system: max(_loaded_at) in the target}
    (F11). A source with no watermark (absent from the target, or a first
    run) loads in full (D3 fixed: the reference's NULL watermark loads nothing).
    """
    feeds = utx_feeds(stg, p)
    parts = []
    for src, df in feeds.items():
        wm = (watermarks or {}).get(src)
        if wm is not None:
            # literal bound: prunes files/partitions at the scan
            df = df.filter(F.col("_loaded_at") > lit_ts(wm) - F.make_dt_interval(days=F.lit(p.lookback_days)))
        parts.append(df)
    return reduce(DataFrame.unionByName, parts)


def spine_id() -> Column:
    """``transaction_unified_id`` from a row of ``spine_rows``."""
    return surrogate_key("source_transaction_id", "_id_kind")


def with_ids(rows: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """The spine's columns from ``spine_rows``, then the columns that a job added to them."""
    made = {"transaction_unified_id": spine_id(), "_unified_at": lit_ts(p.run_ts)}
    added = [c for c in rows.columns if c not in UTX_COLUMNS and c != "_id_kind"]
    return rows.select(*[made[c].alias(c) if c in made else F.col(c) for c in UTX_COLUMNS], *added)


def unified_transactions(stg, p: RunParams = DEFAULT, watermarks: dict | None = None) -> DataFrame:
    """M15, whole rows; ``watermarks`` as in ``spine_rows``."""
    return with_ids(spine_rows(stg, p, watermarks), p)


# ---------------------------------------------------------------------------
# M16 unified chart of accounts
# ---------------------------------------------------------------------------
def unified_chart_of_accounts(qb_accounts: DataFrame, ns_accounts: DataFrame, seed: DataFrame, p: RunParams = DEFAULT):
    cols = ["account_golden_id", "source_account_id", "account_name", "account_number", "account_type",
            "account_sub_type", "classification", "is_active", "source_system"]
    qa = qb_accounts.select(
        surrogate_key("account_id", F.lit("quickbooks")).alias("account_golden_id"),
        F.col("account_id").alias("source_account_id"),
        "account_name", "account_number", "account_type", "account_sub_type", "classification",
        "is_active", "source_system",
    )
    na = ns_accounts.select(
        surrogate_key("account_id", F.lit("netsuite")).alias("account_golden_id"),
        F.col("account_id").alias("source_account_id"),
        "account_name", "account_number", "account_type", null_of("string").alias("account_sub_type"),
        "classification", "is_active", "source_system",
    )
    u = qa.select(*cols).unionByName(na.select(*cols))
    # the seed is a fixed reference file (22 rows): broadcasting it is bounded
    c = F.broadcast(seed.select(
        F.col("account_code").alias("_code"), F.col("source_system").alias("_sys"),
        "canonical_classification", "canonical_category", "financial_statement_line",
        "is_balance_sheet", "is_income_statement",
    ))
    j = u.join(c, (u.account_number == c._code) & (u.source_system == c._sys), "left")
    return j.select(
        "account_golden_id", "source_account_id", "source_system", "account_name", "account_number",
        "account_type", "account_sub_type",
        F.coalesce("canonical_classification", "classification").alias("classification"),
        F.coalesce("canonical_category", "account_type").alias("category"),
        F.coalesce("financial_statement_line", F.lit("Other")).alias("financial_statement_line"),
        F.coalesce("is_balance_sheet", F.lit(False)).alias("is_balance_sheet"),
        F.coalesce("is_income_statement", F.lit(False)).alias("is_income_statement"),
        "is_active",
        lit_ts(p.run_ts).alias("_golden_record_updated_at"),
    )
