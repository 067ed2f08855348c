"""Raw source tables derived from the driver's test tables.

The reference lands JSON from QuickBooks, Stripe, Salesforce, NetSuite and
Plaid into ``raw_*`` tables. The test environment ships TPC-H-like parquet
tables instead, so this module derives the thirteen staged raw tables from
them with deterministic, row-local projections (no joins, no shuffles except
the one daily-balance aggregate). Every derived table grows linearly with its
driver table, so the jobs downstream scale with the data.

Mapping (see README):

* customer -> quickbooks.customers, stripe.customers, salesforce.accounts
  (membership of a customer in each system is decided by its key)
* orders   -> quickbooks.invoices, quickbooks.payments (F and P orders),
              salesforce.opportunities; dates shifted forward by SHIFT_DAYS
* lineitem -> netsuite.transactions; part -> quickbooks.accounts;
  supplier -> netsuite.accounts
* events   -> stripe.charges (purchase, error), stripe.balance_transactions
              (purchase, view, error), plaid.transactions (click, signup),
              plaid.balances (last value per account and day)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ledgerlake.functions import MONEY, RATE, lit_date, lit_ts
from ledgerlake.params import DEFAULT, RunParams

# orders span 1995-01-01..2001-08-01; shifted they end on 2024-01-30 and
# overlap the events table (2024-01-01..2024-01-30)
SHIFT_DAYS = 8217

# Account codes of the chart-of-accounts seed per source, plus
# one code that is not in the seed (so the seed join both hits and misses).
QB_ACCOUNT_NUMBERS = [
    "1000", "1100", "1200", "1500", "2000", "2100", "2500", "3000",
    "4000", "4100", "5000", "6000", "6100", "6200", "7000", "9900",
]
NS_ACCOUNT_NUMBERS = ["1000", "1100", "2000", "3000", "4000", "5000", "6000", "8800"]
# QuickBooks account types and their classification, same order
QB_ACCOUNT_TYPES = [
    ("Bank", "Asset"),
    ("Accounts Receivable", "Asset"),
    ("Other Current Asset", "Asset"),
    ("Fixed Asset", "Asset"),
    ("Accounts Payable", "Liability"),
    ("Other Current Liability", "Liability"),
    ("Long Term Liability", "Liability"),
    ("Equity", "Equity"),
    ("Income", "Revenue"),
    ("Other Income", "Revenue"),
    ("Cost of Goods Sold", "Expense"),
    ("Expense", "Expense"),
]
# NetSuite account types (the last one maps to classification 'Other')
NS_ACCOUNT_TYPES = [
    "Bank", "AcctRec", "OthCurrAsset", "FixedAsset", "OthAsset", "AcctPay",
    "CreditCard", "OthCurrLiab", "LongTermLiab", "Equity", "Income",
    "OthIncome", "Expense", "OthExpense", "COGS", "NonPosting",
]

DRIVER_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "events")


# key columns of the driver tables (hash fan-out keys)
DRIVER_KEYS = {
    "customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "part": ["p_partkey"], "supplier": ["s_suppkey"], "events": ["event_id"],
    "nation": ["n_nationkey"], "region": ["r_regionkey"],
}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; timestamp_ntz columns become UTC timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, TimestampNTZType)
    }
    df = df.withColumns(casts) if casts else df
    return df


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def _epoch_plus_hours(base_epoch: int, hours: Column) -> Column:
    return F.timestamp_seconds(F.lit(base_epoch) + hours * 3600)


def _day_loaded(d: Column, p: RunParams) -> Column:
    """Daily 06:00 batch after the record's day, never later than the run."""
    return F.least(
        F.to_timestamp(F.date_add(d, 1)) + F.expr("interval 6 hours"),
        lit_ts(p.run_ts),
    )


def _master_loaded(k: Column, p: RunParams) -> Column:
    """Master data reloaded on one of the last five daily runs."""
    return F.to_timestamp(F.date_sub(lit_date(p.as_of), (k % 5).cast("int"))) + F.expr(
        "interval 6 hours"
    )


def _stamp(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("_source_system", F.lit(source))


def _shifted(c: str) -> Column:
    return F.date_add(F.to_date(F.col(c)), SHIFT_DAYS)


# ---------------------------------------------------------------------------
# QuickBooks
# ---------------------------------------------------------------------------
def quickbooks_customers(customer: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    k = F.col("c_custkey")
    created = _epoch_plus_hours(1514764800, k % 10000)  # 2018-01-01
    email_key = F.when(k % 50 == 7, k - 2).otherwise(k)
    out = customer.select(
        _cat("QB-", _s(k)).alias("id"),
        F.col("c_name").alias("display_name"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(_cat("Company ", _s(k))).alias("company_name"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(_cat("Given", _s(k))).alias("given_name"),
        _cat("Family", _s(k)).alias("family_name"),
        F.when(k % 13 == 0, F.lit(None))
        .otherwise(_cat("C", _s(email_key), "@EX.com "))
        .alias("primary_email_addr_address"),
        _cat("555-", _s(k)).alias("primary_phone_free_form_number"),
        _cat(_s(k), " Main St").alias("bill_addr_line1"),
        _cat("City", _s("c_nationkey")).alias("bill_addr_city"),
        _cat("ST", _s(F.col("c_nationkey") % 5)).alias("bill_addr_country_sub_division_code"),
        _s(k + 10000).alias("bill_addr_postal_code"),
        F.lit("US").alias("bill_addr_country"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.col("c_acctbal").cast(MONEY).alias("balance"),
        F.when(k % 4 == 0, F.lit(" eur")).otherwise(F.lit("usd ")).alias("currency_ref_value"),
        _iso(created).alias("meta_create_time"),
        _iso(created + F.make_dt_interval(days=(k % 400).cast("int"))).alias("meta_last_updated_time"),
        _master_loaded(k, p).alias("_loaded_at"),
    )
    return _stamp(out, "quickbooks")


def quickbooks_invoices(orders: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    ok = F.col("o_orderkey")
    d = _shifted("o_orderdate")
    total = F.col("o_totalprice").cast(MONEY)
    out = orders.select(
        _s(ok).alias("id"),
        _cat("QB-", _s("o_custkey")).alias("customer_ref_value"),
        _cat("INV-", _s(ok)).alias("doc_number"),
        total.alias("total_amt"),
        F.when(F.col("o_orderstatus") == "F", F.lit(0).cast(MONEY))
        .when(F.col("o_orderstatus") == "P", (total / 2).cast(MONEY))
        .otherwise(total)
        .alias("balance"),
        F.lit(" usd").alias("currency_ref_value"),
        d.alias("txn_date"),
        F.when(ok % 101 == 0, F.lit(None).cast("date")).otherwise(F.date_add(d, 30)).alias("due_date"),
        F.lit("EmailSent").alias("email_status"),
        _iso(F.to_timestamp(d) + F.expr("interval 9 hours")).alias("meta_create_time"),
        _iso(F.to_timestamp(d) + F.expr("interval 33 hours")).alias("meta_last_updated_time"),
        _day_loaded(d, p).alias("_loaded_at"),
    )
    return _stamp(out, "quickbooks")


def quickbooks_payments(orders: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    ok = F.col("o_orderkey")
    d = F.date_add(_shifted("o_orderdate"), (ok % 25).cast("int"))
    total = F.col("o_totalprice").cast(MONEY)
    out = orders.filter(F.col("o_orderstatus").isin("F", "P")).select(
        _cat("PMT-", _s(ok)).alias("id"),
        _cat("QB-", _s("o_custkey")).alias("customer_ref_value"),
        F.when(F.col("o_orderstatus") == "F", total).otherwise((total / 2).cast(MONEY)).alias("total_amt"),
        F.lit("USD").alias("currency_ref_value"),
        d.alias("txn_date"),
        F.lit("1000").alias("deposit_to_account_ref_value"),
        F.when(ok % 3 == 0, F.lit(None).cast("string"))
        .when(ok % 3 == 1, F.lit("check"))
        .otherwise(F.lit("ach"))
        .alias("payment_method_ref_value"),
        _iso(F.to_timestamp(d) + F.expr("interval 10 hours")).alias("meta_create_time"),
        _iso(F.to_timestamp(d) + F.expr("interval 10 hours")).alias("meta_last_updated_time"),
        _day_loaded(d, p).alias("_loaded_at"),
    )
    return _stamp(out, "quickbooks")


def quickbooks_accounts(part: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    pk = F.col("p_partkey")
    ti = (pk % len(QB_ACCOUNT_TYPES) + 1).cast("int")
    created = _epoch_plus_hours(1420070400, pk % 10000)  # 2015-01-01
    out = part.select(
        _cat("QBA-", _s(pk)).alias("id"),
        F.col("p_name").alias("name"),
        F.element_at(F.array(*[F.lit(t) for t, _ in QB_ACCOUNT_TYPES]), ti).alias("account_type"),
        F.col("p_type").alias("account_sub_type"),
        F.element_at(
            F.array(*[F.lit(n) for n in QB_ACCOUNT_NUMBERS]),
            (pk % len(QB_ACCOUNT_NUMBERS) + 1).cast("int"),
        ).alias("acct_num"),
        F.element_at(F.array(*[F.lit(c) for _, c in QB_ACCOUNT_TYPES]), ti).alias("classification"),
        (F.col("p_retailprice").cast(MONEY) * F.col("p_size")).cast(MONEY).alias("current_balance"),
        F.lit("usd").alias("currency_ref_value"),
        (pk % 10 != 0).alias("active"),
        _iso(created).alias("meta_create_time"),
        _iso(created + F.make_dt_interval(days=(pk % 300).cast("int"))).alias("meta_last_updated_time"),
        _master_loaded(pk, p).alias("_loaded_at"),
    )
    return _stamp(out, "quickbooks")


# ---------------------------------------------------------------------------
# NetSuite
# ---------------------------------------------------------------------------
def netsuite_accounts(supplier: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    sk = F.col("s_suppkey")
    out = supplier.select(
        _cat("NSA-", _s(sk)).alias("id"),
        F.col("s_name").alias("acct_name"),
        F.element_at(
            F.array(*[F.lit(n) for n in NS_ACCOUNT_NUMBERS]),
            (sk % len(NS_ACCOUNT_NUMBERS) + 1).cast("int"),
        ).alias("acct_number"),
        F.element_at(
            F.array(*[F.lit(t) for t in NS_ACCOUNT_TYPES]),
            (sk % len(NS_ACCOUNT_TYPES) + 1).cast("int"),
        ).alias("acct_type"),
        F.lit("CURRENT").alias("general_rate_type"),
        F.when(sk % 4 == 0, F.lit(None)).otherwise(_cat("NSA-", _s(sk - sk % 4))).alias("parent"),
        (F.col("s_acctbal") < 0).alias("is_inactive"),
        _master_loaded(sk, p).alias("_loaded_at"),
    )
    return _stamp(out, "netsuite")


def netsuite_line_id() -> Column:
    """Unique id of a lineitem row: (orderkey, linenumber) repeats in the driver
    data; with part, supplier and ship date it is unique at every scale."""
    return _cat(_s("l_orderkey"), "-", _s("l_linenumber"), "-", _s("l_partkey"), "-", _s("l_suppkey"), "-",
                F.date_format("l_shipdate", "yyyyMMdd"))


def netsuite_transactions(lineitem: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    rl = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    ty = (
        F.when(F.col("l_linenumber") == 7, "Deposit")
        .when(rl == "AF", "CustInvc")
        .when(rl == "AO", "CustPymt")
        .when(rl == "NF", "VendBill")
        .when(rl == "NO", "VendPymt")
        .when(rl == "RF", "Journal")
        .otherwise("CustCred")
    )
    d = _shifted("l_shipdate")
    amt = F.col("l_extendedprice").cast(MONEY)
    ok = F.col("l_orderkey")
    line_id = netsuite_line_id()
    out = lineitem.withColumn("_type", ty).select(
        line_id.alias("id"),
        _cat("NS-", line_id).alias("tran_id"),
        F.col("_type").alias("type"),
        F.when(F.col("l_linestatus") == "F", "Posted").otherwise("Open").alias("status"),
        F.when(F.col("_type").startswith("Cust"), _cat("NS-", _s("l_partkey")))
        .when(F.col("_type").startswith("Vend"), _cat("VEND-", _s("l_suppkey")))
        .alias("entity"),
        F.lit("1").alias("subsidiary"),
        _s(F.col("l_suppkey") % 5).alias("department"),
        F.lit("1").alias("currency"),
        (F.lit(1) + F.col("l_tax")).cast(RATE).alias("exchange_rate"),
        F.when(F.col("l_returnflag") == "R", (-amt).cast(MONEY)).otherwise(amt).alias("total"),
        d.alias("tran_date"),
        F.date_add(d, 30).alias("due_date"),
        (F.col("l_linenumber") != 2).alias("posting"),
        F.when(ok % 53 == 0, F.lit(None).cast("boolean")).otherwise(ok % 50 == 0).alias("voided"),
        _cat("line ", _s("l_linenumber")).alias("memo"),
        _iso(F.to_timestamp(d) + F.expr("interval 8 hours")).alias("date_created"),
        _iso(F.to_timestamp(d) + F.expr("interval 8 hours")).alias("last_modified_date"),
        _day_loaded(d, p).alias("_loaded_at"),
    )
    return _stamp(out, "netsuite")


# ---------------------------------------------------------------------------
# Stripe
# ---------------------------------------------------------------------------
def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def stripe_customers(customer: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    k = F.col("c_custkey")
    ks = _s(k)
    nk = _s("c_nationkey")
    address = (
        F.when(k % 97 == 0, _cat('{"line1": "', ks))
        .when(
            k % 89 == 0,
            _cat('{"line1": "', ks, ' Market St", "city": {"name": "City', nk, '"}, "state": "S1"}'),
        )
        .otherwise(
            _cat(
                '{"line1": "', ks, ' Market St", "city": "City', nk, '", "state": "S',
                _s(F.col("c_nationkey") % 7), '", "postal_code": "', _s(k + 20000),
                '", "country": "US"}',
            )
        )
    )
    metadata = _cat(
        "{",
        F.concat_ws(
            ", ",
            F.when(k % 2 == 0, _cat('"qb_customer_id": "QB-', ks, '"')),
            F.when(k % 3 == 1, _cat('"ns_customer_id": "NS-', ks, '"')),
            F.when(k % 5 != 4, _cat('"sf_account_id": "001SF', ks, '"')),
        ),
        "}",
    )
    name = (
        F.when(k % 10 == 0, _cat("Mono", ks))
        .when(k % 10 == 1, _cat("Ann Lee Park", ks))
        .otherwise(_cat("Pat Doe", ks))
    )
    out = customer.select(
        _cat("cus_", ks).alias("id"),
        name.alias("name"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(_cat("c", ks, "@ex.com")).alias("email"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(_cat("+1-555-", ks)).alias("phone"),
        address.alias("address"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.lit("usd")).alias("currency"),
        (k % 9 == 0).alias("delinquent"),
        metadata.alias("metadata"),
        (F.lit(1546300800) + (k % 10000) * 3600).alias("created"),  # 2019-01-01
        _master_loaded(k, p).alias("_loaded_at"),
    )
    return _stamp(out, "stripe")


def stripe_charges(events: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    e = _s("event_id")
    purchase = F.col("event_type") == "purchase"
    refunded = F.col("event_id") % 20 == 0
    out = events.filter(F.col("event_type").isin("purchase", "error")).select(
        _cat("ch_", e).alias("id"),
        _cat("cus_", _s("user_id")).alias("customer"),
        _cents().alias("amount"),
        F.when(refunded, _cents()).otherwise(F.lit(0).cast("bigint")).alias("amount_refunded"),
        F.lit("usd").alias("currency"),
        F.when(purchase, "succeeded").otherwise("failed").alias("status"),
        purchase.alias("paid"),
        refunded.alias("refunded"),
        F.lit(False).alias("disputed"),
        _cat("pm_", e).alias("payment_method"),
        F.lit('{"type": "card"}').alias("payment_method_details"),
        _cat("Order ", e).alias("description"),
        F.lit(None).cast("string").alias("invoice"),
        _cat('{"order_id": "ORD-', e, '", "customer_email": "c', _s("user_id"), '@ex.com"}').alias("metadata"),
        F.unix_seconds(F.col("ts")).alias("created"),
        _day_loaded(F.to_date("ts"), p).alias("_loaded_at"),
    )
    return _stamp(out, "stripe")


def stripe_balance_transactions(events: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    et = F.col("event_type")
    cents = _cents()
    amount = F.when(et == "purchase", cents).otherwise(-cents)
    fee = F.when(et == "purchase", F.round(cents * 0.029).cast("bigint") + 30).otherwise(F.lit(0).cast("bigint"))
    created = F.unix_seconds(F.col("ts"))
    out = events.filter(et.isin("purchase", "view", "error")).select(
        _cat("txn_", _s("event_id")).alias("id"),
        amount.alias("amount"),
        fee.alias("fee"),
        (amount - fee).alias("net"),
        F.lit("usd").alias("currency"),
        F.when(et == "purchase", "charge")
        .when(et == "view", "payout")
        .when(F.col("event_id") % 2 == 0, "refund")
        .otherwise("adjustment")
        .alias("type"),
        F.lit("available").alias("status"),
        _cat("ch_", _s("event_id")).alias("source"),
        et.alias("description"),
        created.alias("created"),
        (created + 172800).alias("available_on"),
        _day_loaded(F.to_date("ts"), p).alias("_loaded_at"),
    )
    return _stamp(out, "stripe")


# ---------------------------------------------------------------------------
# Plaid
# ---------------------------------------------------------------------------
def _plaid_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin("click", "signup"))


def plaid_transactions(events: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    k = F.get_json_object(F.col("props"), "$.k")
    ev = F.col("event_id")
    amt = F.col("value").cast(MONEY)
    et_up = F.upper(F.col("event_type"))
    out = _plaid_events(events).select(
        _cat("ptx_", _s(ev)).alias("transaction_id"),
        _cat("acc_", _s(F.col("user_id") % 10)).alias("account_id"),
        F.when(F.col("event_type") == "click", amt).otherwise((-amt).cast(MONEY)).alias("amount"),
        F.lit("usd").alias("iso_currency_code"),
        F.to_date("ts").alias("date"),
        F.date_sub(F.to_date("ts"), 1).alias("authorized_date"),
        _cat("Merchant ", _s(F.col("user_id") % 50)).alias("name"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None))
        .otherwise(_cat("merchant", _s(F.col("user_id") % 50)))
        .alias("merchant_name"),
        F.when(ev % 3 == 0, "online").when(ev % 3 == 1, "in store").otherwise("other").alias("payment_channel"),
        F.when(ev % 37 == 0, F.lit(None).cast("boolean")).otherwise(ev % 10 == 0).alias("pending"),
        _s(F.col("user_id") % 50 + 10000000).alias("category_id"),
        F.when(ev % 41 == 0, F.lit('["Transfer", null, "Debit"]'))
        .otherwise(_cat('["Shops", "Cat', k, '"]'))
        .alias("category"),
        _cat('{"primary": "', et_up, '", "detailed": "', et_up, "_", k, '"}').alias("personal_finance_category"),
        _day_loaded(F.to_date("ts"), p).alias("_loaded_at"),
    )
    return _stamp(out, "plaid")


def event_order() -> Column:
    """Total order of events as one fixed-width value: event time in
    microseconds, ties broken by event id. Unlike a struct ordering it lets
    ``max_by`` run as a hash aggregate, and the pick is deterministic."""
    d = "decimal(38,0)"
    return F.unix_micros(F.col("ts")).cast(d) * F.lit(10**18).cast(d) + F.col("event_id").cast(d)


def plaid_balances(events: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    """Last observed value per account and day (one aggregate, map-side combined)."""
    daily = (
        _plaid_events(events)
        .groupBy(
            _cat("acc_", _s(F.col("user_id") % 10)).alias("account_id"),
            F.to_date("ts").alias("snapshot_date"),
        )
        .agg(F.max_by(F.col("value"), event_order()).alias("_last"))
    )
    current = (F.col("_last").cast(MONEY) * 100).cast(MONEY)
    out = daily.select(
        "account_id",
        current.alias("current"),
        (current - 25).cast(MONEY).alias("available"),
        F.lit(None).cast(MONEY).alias("limit"),
        F.lit("usd").alias("iso_currency_code"),
        "snapshot_date",
        _day_loaded(F.col("snapshot_date"), p).alias("_loaded_at"),
    )
    return _stamp(out, "plaid")


# ---------------------------------------------------------------------------
# Salesforce
# ---------------------------------------------------------------------------
def salesforce_accounts(customer: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    k = F.col("c_custkey")
    ks = _s(k)
    created = _epoch_plus_hours(1451606400, k % 10000)  # 2016-01-01
    out = customer.select(
        _cat("001SF", ks).alias("id"),
        _cat("Account ", ks).alias("name"),
        F.when(k % 3 == 0, "Customer - Direct")
        .when(k % 3 == 1, "Customer - Channel")
        .otherwise("Prospect")
        .alias("type"),
        F.col("c_mktsegment").alias("industry"),
        (F.col("c_acctbal").cast(MONEY) * 1000).cast(MONEY).alias("annual_revenue"),
        (k % 500 + 1).cast("bigint").alias("number_of_employees"),
        F.when(k % 2 == 0, F.lit(None)).otherwise(_cat(ks, " Oak Ave")).alias("billing_street"),
        _cat("SFCity", _s("c_nationkey")).alias("billing_city"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit("CA")).alias("billing_state"),
        _s(k + 30000).alias("billing_postal_code"),
        F.lit("USA").alias("billing_country"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(_cat("+1-415-", ks)).alias("phone"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(_cat("https://acct", ks, ".example.com")).alias("website"),
        _cat("005U", _s(k % 10)).alias("owner_id"),
        _iso(created).alias("created_date"),
        _iso(created + F.make_dt_interval(days=(k % 700).cast("int"))).alias("last_modified_date"),
        F.when(k % 19 == 0, F.lit(None).cast("boolean")).otherwise(k % 17 == 0).alias("is_deleted"),
        _master_loaded(k, p).alias("_loaded_at"),
    )
    return _stamp(out, "salesforce")


def salesforce_opportunities(orders: DataFrame, p: RunParams = DEFAULT) -> DataFrame:
    ok = F.col("o_orderkey")
    pr = F.col("o_orderpriority")
    won = pr.isin("1-URGENT", "2-HIGH")
    closed = pr.isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    d = _shifted("o_orderdate")
    close = F.date_add(d, 14)
    out = orders.select(
        _cat("006OP", _s(ok)).alias("id"),
        _cat("001SF", _s("o_custkey")).alias("account_id"),
        _cat("Opp ", _s(ok)).alias("name"),
        F.when(won, "Closed Won").when(closed, "Closed Lost").otherwise("Negotiation").alias("stage_name"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.when(ok % 10 == 0, F.lit(None)).otherwise(F.lit("usd")).alias("currency_iso_code"),
        F.when(won, 100).when(closed, 0).otherwise(50).cast(MONEY).alias("probability"),
        close.alias("close_date"),
        F.lit("New Business").alias("type"),
        won.alias("is_won"),
        closed.alias("is_closed"),
        F.year(close).cast("bigint").alias("fiscal_year"),
        F.quarter(close).cast("bigint").alias("fiscal_quarter"),
        _cat("005U", _s(ok % 10)).alias("owner_id"),
        _iso(F.to_timestamp(d)).alias("created_date"),
        _iso(F.to_timestamp(d) + F.expr("interval 1 day")).alias("last_modified_date"),
        (ok % 23 == 0).alias("is_deleted"),
        _day_loaded(d, p).alias("_loaded_at"),
    )
    return _stamp(out, "salesforce")


# ---------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------
RAW_BUILDERS = {
    "quickbooks.customers": ("customer", quickbooks_customers),
    "quickbooks.invoices": ("orders", quickbooks_invoices),
    "quickbooks.payments": ("orders", quickbooks_payments),
    "quickbooks.accounts": ("part", quickbooks_accounts),
    "netsuite.accounts": ("supplier", netsuite_accounts),
    "netsuite.transactions": ("lineitem", netsuite_transactions),
    "stripe.customers": ("customer", stripe_customers),
    "stripe.charges": ("events", stripe_charges),
    "stripe.balance_transactions": ("events", stripe_balance_transactions),
    "plaid.transactions": ("events", plaid_transactions),
    "plaid.balances": ("events", plaid_balances),
    "salesforce.accounts": ("customer", salesforce_accounts),
    "salesforce.opportunities": ("orders", salesforce_opportunities),
}


class DriverRaw:
    """Lazily derived raw tables over one driver directory (``sf_dir``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params
        self._driver: dict[str, DataFrame] = {}

    def driver(self, name: str) -> DataFrame:
        if name not in self._driver:
            self._driver[name] = read_driver_table(self.spark, self.sf_dir, name)
        return self._driver[name]

    def __call__(self, name: str) -> DataFrame:
        src, fn = RAW_BUILDERS[name]
        return fn(self.driver(src), self.params)

    def names(self):
        return list(RAW_BUILDERS)
