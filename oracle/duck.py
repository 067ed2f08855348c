"""DuckDB oracle SQL.

An independent re-statement, in DuckDB SQL, of the raw-table mapping and of
every job, used to check the Spark results (``__spark_entry__.oracle_sql``).
Each query is a chain of named CTEs over the driver's pre-registered views
(customer, orders, lineitem, part, supplier, events); ``sql(final)`` prepends
exactly the CTEs the final SELECT needs, in dependency order.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2024-01-31'"
RUN_TS = "TIMESTAMP '2024-01-31 06:00:00'"
SHIFT = 8217
NULLKEY = "_dbt_utils_surrogate_key_null_"

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def sk(*parts: str) -> str:
    """surrogate key: md5 of '-'-joined string casts, NULL -> placeholder."""
    inner = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '{NULLKEY}')" for p in parts)
    return f"md5(concat_ws('-', {inner}))"


def js(j: str, path: str) -> str:
    """JSON scalar: NULL for malformed JSON, objects and arrays."""
    return (
        f"(CASE WHEN json_valid({j}) THEN CASE WHEN json_type({j}, '{path}') NOT IN ('OBJECT', 'ARRAY') "
        f"THEN json_extract_string({j}, '{path}') END END)"
    )


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


def epoch_ts(sec: str) -> str:
    return f"(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST({sec} AS BIGINT)))"


def day_loaded(d: str) -> str:
    return f"least(CAST(({d}) + 1 AS TIMESTAMP) + INTERVAL 6 HOUR, {RUN_TS})"


def master_loaded(k: str) -> str:
    return f"(CAST({AS_OF} - CAST({k} % 5 AS INTEGER) AS TIMESTAMP) + INTERVAL 6 HOUR)"


def shifted(c: str) -> str:
    return f"(CAST({c} AS DATE) + {SHIFT})"


M = "DECIMAL(18,4)"
B = "DECIMAL(28,9)"

# ---------------------------------------------------------------------------
# Raw tables
# ---------------------------------------------------------------------------
cte("raw_qb_customers", f"""
SELECT 'QB-' || {s('c_custkey')} AS id, c_name AS display_name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Company ' || {s('c_custkey')} END AS company_name,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Given' || {s('c_custkey')} END AS given_name,
  'Family' || {s('c_custkey')} AS family_name,
  CASE WHEN c_custkey % 13 = 0 THEN NULL
       ELSE 'C' || {s('CASE WHEN c_custkey % 50 = 7 THEN c_custkey - 2 ELSE c_custkey END')} || '@EX.com ' END
    AS primary_email_addr_address,
  '555-' || {s('c_custkey')} AS primary_phone_free_form_number,
  {s('c_custkey')} || ' Main St' AS bill_addr_line1,
  'City' || {s('c_nationkey')} AS bill_addr_city,
  'ST' || {s('c_nationkey % 5')} AS bill_addr_country_sub_division_code,
  {s('c_custkey + 10000')} AS bill_addr_postal_code,
  'US' AS bill_addr_country,
  c_acctbal >= 0 AS active,
  CAST(c_acctbal AS {M}) AS balance,
  CASE WHEN c_custkey % 4 = 0 THEN ' eur' ELSE 'usd ' END AS currency_ref_value,
  {iso(epoch_ts('1514764800 + (c_custkey % 10000) * 3600'))} AS meta_create_time,
  {iso(epoch_ts('1514764800 + (c_custkey % 10000) * 3600') + ' + to_days(CAST(c_custkey % 400 AS INTEGER))')}
    AS meta_last_updated_time,
  {master_loaded('c_custkey')} AS _loaded_at
FROM customer""")

cte("raw_qb_invoices", f"""
SELECT {s('o_orderkey')} AS id, 'QB-' || {s('o_custkey')} AS customer_ref_value,
  'INV-' || {s('o_orderkey')} AS doc_number,
  CAST(o_totalprice AS {M}) AS total_amt,
  CASE o_orderstatus WHEN 'F' THEN CAST(0 AS {M})
       WHEN 'P' THEN CAST(CAST(o_totalprice AS {M}) / 2 AS {M})
       ELSE CAST(o_totalprice AS {M}) END AS balance,
  ' usd' AS currency_ref_value,
  {shifted('o_orderdate')} AS txn_date,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {shifted('o_orderdate')} + 30 END AS due_date,
  'EmailSent' AS email_status,
  {iso(f"CAST({shifted('o_orderdate')} AS TIMESTAMP) + INTERVAL 9 HOUR")} AS meta_create_time,
  {iso(f"CAST({shifted('o_orderdate')} AS TIMESTAMP) + INTERVAL 33 HOUR")} AS meta_last_updated_time,
  {day_loaded(shifted('o_orderdate'))} AS _loaded_at
FROM orders""")

_pay_d = f"({shifted('o_orderdate')} + CAST(o_orderkey % 25 AS INTEGER))"
cte("raw_qb_payments", f"""
SELECT 'PMT-' || {s('o_orderkey')} AS id, 'QB-' || {s('o_custkey')} AS customer_ref_value,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS {M})
       ELSE CAST(CAST(o_totalprice AS {M}) / 2 AS {M}) END AS total_amt,
  'USD' AS currency_ref_value,
  {_pay_d} AS txn_date,
  '1000' AS deposit_to_account_ref_value,
  CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'check' ELSE 'ach' END AS payment_method_ref_value,
  {iso(f"CAST({_pay_d} AS TIMESTAMP) + INTERVAL 10 HOUR")} AS meta_create_time,
  {iso(f"CAST({_pay_d} AS TIMESTAMP) + INTERVAL 10 HOUR")} AS meta_last_updated_time,
  {day_loaded(_pay_d)} AS _loaded_at
FROM orders WHERE o_orderstatus IN ('F', 'P')""")

cte("raw_qb_accounts", f"""
SELECT 'QBA-' || {s('p_partkey')} AS id, p_name AS name,
  ['Bank', 'Accounts Receivable', 'Other Current Asset', 'Fixed Asset', 'Accounts Payable',
   'Other Current Liability', 'Long Term Liability', 'Equity', 'Income', 'Other Income',
   'Cost of Goods Sold', 'Expense'][CAST(p_partkey % 12 AS INTEGER) + 1] AS account_type,
  p_type AS account_sub_type,
  ['1000', '1100', '1200', '1500', '2000', '2100', '2500', '3000', '4000', '4100', '5000', '6000',
   '6100', '6200', '7000', '9900'][CAST(p_partkey % 16 AS INTEGER) + 1] AS acct_num,
  ['Asset', 'Asset', 'Asset', 'Asset', 'Liability', 'Liability', 'Liability', 'Equity', 'Revenue',
   'Revenue', 'Expense', 'Expense'][CAST(p_partkey % 12 AS INTEGER) + 1] AS classification,
  CAST(CAST(p_retailprice AS {M}) * p_size AS {M}) AS current_balance,
  'usd' AS currency_ref_value,
  p_partkey % 10 <> 0 AS active,
  {iso(epoch_ts('1420070400 + (p_partkey % 10000) * 3600'))} AS meta_create_time,
  {iso(epoch_ts('1420070400 + (p_partkey % 10000) * 3600') + ' + to_days(CAST(p_partkey % 300 AS INTEGER))')}
    AS meta_last_updated_time,
  {master_loaded('p_partkey')} AS _loaded_at
FROM part""")

cte("raw_ns_accounts", f"""
SELECT 'NSA-' || {s('s_suppkey')} AS id, s_name AS acct_name,
  ['1000', '1100', '2000', '3000', '4000', '5000', '6000', '8800'][CAST(s_suppkey % 8 AS INTEGER) + 1] AS acct_number,
  ['Bank', 'AcctRec', 'OthCurrAsset', 'FixedAsset', 'OthAsset', 'AcctPay', 'CreditCard', 'OthCurrLiab',
   'LongTermLiab', 'Equity', 'Income', 'OthIncome', 'Expense', 'OthExpense', 'COGS',
   'NonPosting'][CAST(s_suppkey % 16 AS INTEGER) + 1] AS acct_type,
  'CURRENT' AS general_rate_type,
  CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'NSA-' || {s('s_suppkey - s_suppkey % 4')} END AS parent,
  s_acctbal < 0 AS is_inactive,
  {master_loaded('s_suppkey')} AS _loaded_at
FROM supplier""")

cte("raw_ns_transactions", f"""
SELECT id, 'NS-' || id AS tran_id, _type AS type,
  CASE WHEN l_linestatus = 'F' THEN 'Posted' ELSE 'Open' END AS status,
  CASE WHEN _type LIKE 'Cust%' THEN 'NS-' || {s('l_partkey')}
       WHEN _type LIKE 'Vend%' THEN 'VEND-' || {s('l_suppkey')} END AS entity,
  '1' AS subsidiary, {s('l_suppkey % 5')} AS department, '1' AS currency,
  CAST(1 + l_tax AS DECIMAL(18,9)) AS exchange_rate,
  CASE WHEN l_returnflag = 'R' THEN CAST(-CAST(l_extendedprice AS {M}) AS {M})
       ELSE CAST(l_extendedprice AS {M}) END AS total,
  d AS tran_date, d + 30 AS due_date,
  l_linenumber <> 2 AS posting,
  CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE l_orderkey % 50 = 0 END AS voided,
  'line ' || {s('l_linenumber')} AS memo,
  {iso("CAST(d AS TIMESTAMP) + INTERVAL 8 HOUR")} AS date_created,
  {iso("CAST(d AS TIMESTAMP) + INTERVAL 8 HOUR")} AS last_modified_date,
  {day_loaded('d')} AS _loaded_at
FROM (
  SELECT *, {s('l_orderkey')} || '-' || {s('l_linenumber')} || '-' || {s('l_partkey')} || '-' || {s('l_suppkey')} || '-' || strftime(l_shipdate, '%Y%m%d') AS id, {shifted('l_shipdate')} AS d,
    CASE WHEN l_linenumber = 7 THEN 'Deposit'
         WHEN l_returnflag || l_linestatus = 'AF' THEN 'CustInvc'
         WHEN l_returnflag || l_linestatus = 'AO' THEN 'CustPymt'
         WHEN l_returnflag || l_linestatus = 'NF' THEN 'VendBill'
         WHEN l_returnflag || l_linestatus = 'NO' THEN 'VendPymt'
         WHEN l_returnflag || l_linestatus = 'RF' THEN 'Journal'
         ELSE 'CustCred' END AS _type
  FROM lineitem) li""")

cte("raw_stripe_customers", f"""
SELECT 'cus_' || ks AS id,
  CASE WHEN c_custkey % 10 = 0 THEN 'Mono' || ks WHEN c_custkey % 10 = 1 THEN 'Ann Lee Park' || ks
       ELSE 'Pat Doe' || ks END AS name,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'c' || ks || '@ex.com' END AS email,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '+1-555-' || ks END AS phone,
  CASE WHEN c_custkey % 97 = 0 THEN '{{"line1": "' || ks
       WHEN c_custkey % 89 = 0 THEN '{{"line1": "' || ks || ' Market St", "city": {{"name": "City' || nk || '"}}, "state": "S1"}}'
       ELSE '{{"line1": "' || ks || ' Market St", "city": "City' || nk || '", "state": "S' || {s('c_nationkey % 7')}
            || '", "postal_code": "' || {s('c_custkey + 20000')} || '", "country": "US"}}' END AS address,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'usd' END AS currency,
  c_custkey % 9 = 0 AS delinquent,
  '{{' || concat_ws(', ',
     CASE WHEN c_custkey % 2 = 0 THEN '"qb_customer_id": "QB-' || ks || '"' END,
     CASE WHEN c_custkey % 3 = 1 THEN '"ns_customer_id": "NS-' || ks || '"' END,
     CASE WHEN c_custkey % 5 <> 4 THEN '"sf_account_id": "001SF' || ks || '"' END) || '}}' AS metadata,
  1546300800 + (c_custkey % 10000) * 3600 AS created,
  {master_loaded('c_custkey')} AS _loaded_at
FROM (SELECT *, {s('c_custkey')} AS ks, {s('c_nationkey')} AS nk FROM customer) c""")

_cents = "CAST(round(value * 100) AS BIGINT)"
cte("raw_stripe_charges", f"""
SELECT 'ch_' || {s('event_id')} AS id, 'cus_' || {s('user_id')} AS customer,
  {_cents} AS amount,
  CASE WHEN event_id % 20 = 0 THEN {_cents} ELSE CAST(0 AS BIGINT) END AS amount_refunded,
  'usd' AS currency,
  CASE WHEN event_type = 'purchase' THEN 'succeeded' ELSE 'failed' END AS status,
  event_type = 'purchase' AS paid, event_id % 20 = 0 AS refunded, false AS disputed,
  'pm_' || {s('event_id')} AS payment_method, '{{"type": "card"}}' AS payment_method_details,
  'Order ' || {s('event_id')} AS description, CAST(NULL AS VARCHAR) AS invoice,
  '{{"order_id": "ORD-' || {s('event_id')} || '", "customer_email": "c' || {s('user_id')} || '@ex.com"}}' AS metadata,
  epoch_us(ts) // 1000000 AS created,
  {day_loaded('CAST(ts AS DATE)')} AS _loaded_at
FROM events WHERE event_type IN ('purchase', 'error')""")

cte("raw_stripe_balance_transactions", f"""
SELECT 'txn_' || {s('event_id')} AS id, amount, fee, amount - fee AS net, 'usd' AS currency,
  CASE WHEN event_type = 'purchase' THEN 'charge' WHEN event_type = 'view' THEN 'payout'
       WHEN event_id % 2 = 0 THEN 'refund' ELSE 'adjustment' END AS type,
  'available' AS status, 'ch_' || {s('event_id')} AS source, event_type AS description,
  created, created + 172800 AS available_on,
  {day_loaded('CAST(ts AS DATE)')} AS _loaded_at
FROM (
  SELECT *, CASE WHEN event_type = 'purchase' THEN {_cents} ELSE -{_cents} END AS amount,
    CASE WHEN event_type = 'purchase' THEN CAST(round({_cents} * 0.029) AS BIGINT) + 30 ELSE CAST(0 AS BIGINT) END AS fee,
    epoch_us(ts) // 1000000 AS created
  FROM events WHERE event_type IN ('purchase', 'view', 'error')) e""")

cte("raw_plaid_transactions", f"""
SELECT 'ptx_' || {s('event_id')} AS transaction_id, 'acc_' || {s('user_id % 10')} AS account_id,
  CASE WHEN event_type = 'click' THEN CAST(value AS {M}) ELSE CAST(-CAST(value AS {M}) AS {M}) END AS amount,
  'usd' AS iso_currency_code, CAST(ts AS DATE) AS date, CAST(ts AS DATE) - 1 AS authorized_date,
  'Merchant ' || {s('user_id % 50')} AS name,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'merchant' || {s('user_id % 50')} END AS merchant_name,
  CASE event_id % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'in store' ELSE 'other' END AS payment_channel,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE event_id % 10 = 0 END AS pending,
  {s('user_id % 50 + 10000000')} AS category_id,
  CASE WHEN event_id % 41 = 0 THEN '["Transfer", null, "Debit"]'
       ELSE '["Shops", "Cat' || json_extract_string(props, '$.k') || '"]' END AS category,
  '{{"primary": "' || upper(event_type) || '", "detailed": "' || upper(event_type) || '_'
    || json_extract_string(props, '$.k') || '"}}' AS personal_finance_category,
  {day_loaded('CAST(ts AS DATE)')} AS _loaded_at
FROM events WHERE event_type IN ('click', 'signup')""")

cte("raw_plaid_balances", f"""
SELECT account_id, CAST(CAST(value AS {M}) * 100 AS {M}) AS current,
  CAST(CAST(CAST(value AS {M}) * 100 AS {M}) - 25 AS {M}) AS available,
  CAST(NULL AS {M}) AS "limit", 'usd' AS iso_currency_code, snapshot_date,
  {day_loaded('snapshot_date')} AS _loaded_at
FROM (
  SELECT 'acc_' || {s('user_id % 10')} AS account_id, CAST(ts AS DATE) AS snapshot_date, value
  FROM events WHERE event_type IN ('click', 'signup')
  QUALIFY row_number() OVER (PARTITION BY user_id % 10, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1) b""")

cte("raw_sf_accounts", f"""
SELECT '001SF' || ks AS id, 'Account ' || ks AS name,
  CASE c_custkey % 3 WHEN 0 THEN 'Customer - Direct' WHEN 1 THEN 'Customer - Channel' ELSE 'Prospect' END AS type,
  c_mktsegment AS industry,
  CAST(CAST(c_acctbal AS {M}) * 1000 AS {M}) AS annual_revenue,
  CAST(c_custkey % 500 + 1 AS BIGINT) AS number_of_employees,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE ks || ' Oak Ave' END AS billing_street,
  'SFCity' || {s('c_nationkey')} AS billing_city,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'CA' END AS billing_state,
  {s('c_custkey + 30000')} AS billing_postal_code, 'USA' AS billing_country,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '+1-415-' || ks END AS phone,
  CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'https://acct' || ks || '.example.com' END AS website,
  '005U' || {s('c_custkey % 10')} AS owner_id,
  {iso(epoch_ts('1451606400 + (c_custkey % 10000) * 3600'))} AS created_date,
  {iso(epoch_ts('1451606400 + (c_custkey % 10000) * 3600') + ' + to_days(CAST(c_custkey % 700 AS INTEGER))')}
    AS last_modified_date,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey % 17 = 0 END AS is_deleted,
  {master_loaded('c_custkey')} AS _loaded_at
FROM (SELECT *, {s('c_custkey')} AS ks FROM customer) c""")

cte("raw_sf_opportunities", f"""
SELECT '006OP' || {s('o_orderkey')} AS id, '001SF' || {s('o_custkey')} AS account_id,
  'Opp ' || {s('o_orderkey')} AS name,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Closed Won'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'Closed Lost' ELSE 'Negotiation' END AS stage_name,
  CAST(o_totalprice AS {M}) AS amount,
  CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'usd' END AS currency_iso_code,
  CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 100 WHEN o_orderpriority = '3-MEDIUM' THEN 0
       ELSE 50 END AS {M}) AS probability,
  d + 14 AS close_date, 'New Business' AS type,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_won,
  o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_closed,
  CAST(year(d + 14) AS BIGINT) AS fiscal_year, CAST(quarter(d + 14) AS BIGINT) AS fiscal_quarter,
  '005U' || {s('o_orderkey % 10')} AS owner_id,
  {iso('CAST(d AS TIMESTAMP)')} AS created_date,
  {iso('CAST(d AS TIMESTAMP) + INTERVAL 1 DAY')} AS last_modified_date,
  o_orderkey % 23 = 0 AS is_deleted,
  {day_loaded('d')} AS _loaded_at
FROM (SELECT *, {shifted('o_orderdate')} AS d FROM orders) o""")

# ---------------------------------------------------------------------------
# Staging
# ---------------------------------------------------------------------------
cte("stg_qb_accounts", f"""
SELECT id AS account_id, name AS account_name, account_type, account_sub_type, acct_num AS account_number,
  classification, CAST(current_balance AS {M}) AS current_balance, upper(trim(currency_ref_value)) AS currency_code,
  active AS is_active, CAST(meta_create_time AS TIMESTAMP) AS created_at,
  CAST(meta_last_updated_time AS TIMESTAMP) AS updated_at, _loaded_at, 'quickbooks' AS source_system
FROM raw_qb_accounts""")

cte("stg_qb_customers", f"""
SELECT id AS customer_id, display_name, company_name, given_name AS first_name, family_name AS last_name,
  primary_email_addr_address AS email, primary_phone_free_form_number AS phone,
  bill_addr_line1 AS billing_address_line1, bill_addr_city AS billing_city,
  bill_addr_country_sub_division_code AS billing_state, bill_addr_postal_code AS billing_postal_code,
  bill_addr_country AS billing_country, active AS is_active, CAST(balance AS {M}) AS outstanding_balance,
  upper(trim(currency_ref_value)) AS currency_code, CAST(meta_create_time AS TIMESTAMP) AS created_at,
  CAST(meta_last_updated_time AS TIMESTAMP) AS updated_at, _loaded_at, 'quickbooks' AS source_system
FROM raw_qb_customers""")

cte("stg_qb_invoices", f"""
SELECT id AS invoice_id, customer_ref_value AS customer_id, doc_number AS invoice_number,
  CAST(total_amt AS {M}) AS total_amount, CAST(balance AS {M}) AS balance_due,
  upper(trim(currency_ref_value)) AS currency_code, txn_date AS invoice_date, due_date, email_status,
  CASE WHEN balance = 0 THEN 'paid' WHEN due_date < {AS_OF} THEN 'overdue' ELSE 'open' END AS payment_status,
  CAST(meta_create_time AS TIMESTAMP) AS created_at, CAST(meta_last_updated_time AS TIMESTAMP) AS updated_at,
  _loaded_at, 'quickbooks' AS source_system
FROM raw_qb_invoices""")

cte("stg_qb_payments", f"""
SELECT id AS payment_id, customer_ref_value AS customer_id, CAST(total_amt AS {M}) AS payment_amount,
  upper(trim(currency_ref_value)) AS currency_code, txn_date AS payment_date,
  deposit_to_account_ref_value AS deposit_account_id, coalesce(payment_method_ref_value, 'unknown') AS payment_method,
  CAST(meta_create_time AS TIMESTAMP) AS created_at, CAST(meta_last_updated_time AS TIMESTAMP) AS updated_at,
  _loaded_at, 'quickbooks' AS source_system
FROM raw_qb_payments""")

cte("stg_stripe_charges", f"""
SELECT id AS charge_id, customer AS stripe_customer_id,
  CAST(amount / 100.0 AS {M}) AS charge_amount, CAST(amount_refunded / 100.0 AS {M}) AS refunded_amount,
  upper(currency) AS currency_code, status AS charge_status, paid AS is_paid, refunded AS is_refunded,
  disputed AS is_disputed, payment_method AS payment_method_id,
  {js('payment_method_details', '$.type')} AS payment_method_type, description, invoice AS stripe_invoice_id,
  {js('metadata', '$.order_id')} AS external_order_id, {js('metadata', '$.customer_email')} AS customer_email,
  {epoch_ts('created')} AS created_at, _loaded_at, 'stripe' AS source_system
FROM raw_stripe_charges""")

cte("stg_stripe_customers", f"""
SELECT id AS stripe_customer_id, name AS customer_name, email, phone,
  {js('address', '$.line1')} AS address_line1, {js('address', '$.city')} AS city,
  {js('address', '$.state')} AS state, {js('address', '$.postal_code')} AS postal_code,
  {js('address', '$.country')} AS country, upper(coalesce(currency, 'USD')) AS currency_code,
  delinquent AS is_delinquent,
  {js('metadata', '$.qb_customer_id')} AS quickbooks_customer_id,
  {js('metadata', '$.ns_customer_id')} AS netsuite_customer_id,
  {js('metadata', '$.sf_account_id')} AS salesforce_account_id,
  {epoch_ts('created')} AS created_at, _loaded_at, 'stripe' AS source_system
FROM raw_stripe_customers""")

cte("stg_stripe_balance_transactions", f"""
SELECT id AS balance_transaction_id, CAST(amount / 100.0 AS {M}) AS amount, CAST(fee / 100.0 AS {M}) AS fee_amount,
  CAST(net / 100.0 AS {M}) AS net_amount, upper(currency) AS currency_code, type AS transaction_type,
  status AS transaction_status, source AS source_id, description,
  {epoch_ts('created')} AS created_at, {epoch_ts('available_on')} AS available_on,
  _loaded_at, 'stripe' AS source_system
FROM raw_stripe_balance_transactions""")

cte("stg_ns_transactions", f"""
SELECT id AS transaction_id, tran_id AS transaction_number, type AS transaction_type, status AS transaction_status,
  entity AS entity_id, subsidiary AS subsidiary_id, department AS department_id, currency AS currency_id,
  exchange_rate, CAST(total AS {M}) AS total_amount, CAST(CAST(total AS DECIMAL(28,4)) * exchange_rate AS {B}) AS total_amount_base,
  tran_date AS transaction_date, due_date, posting AS is_posting, voided AS is_voided, memo,
  CAST(date_created AS TIMESTAMP) AS created_at, CAST(last_modified_date AS TIMESTAMP) AS updated_at,
  _loaded_at, 'netsuite' AS source_system
FROM raw_ns_transactions WHERE voided = false""")

cte("stg_ns_accounts", """
SELECT id AS account_id, acct_name AS account_name, acct_number AS account_number, acct_type AS account_type,
  general_rate_type AS rate_type, parent AS parent_account_id, is_inactive, NOT is_inactive AS is_active,
  CASE acct_type
    WHEN 'Bank' THEN 'Asset' WHEN 'AcctRec' THEN 'Asset' WHEN 'OthCurrAsset' THEN 'Asset'
    WHEN 'FixedAsset' THEN 'Asset' WHEN 'OthAsset' THEN 'Asset'
    WHEN 'AcctPay' THEN 'Liability' WHEN 'CreditCard' THEN 'Liability' WHEN 'OthCurrLiab' THEN 'Liability'
    WHEN 'LongTermLiab' THEN 'Liability' WHEN 'Equity' THEN 'Equity'
    WHEN 'Income' THEN 'Revenue' WHEN 'OthIncome' THEN 'Revenue'
    WHEN 'Expense' THEN 'Expense' WHEN 'OthExpense' THEN 'Expense' WHEN 'COGS' THEN 'Expense'
    ELSE 'Other' END AS classification,
  _loaded_at, 'netsuite' AS source_system
FROM raw_ns_accounts""")

cte("stg_plaid_transactions", f"""
SELECT transaction_id AS plaid_transaction_id, account_id AS plaid_account_id,
  CAST(amount * -1 AS {M}) AS amount, upper(iso_currency_code) AS currency_code,
  date AS transaction_date, authorized_date, name AS merchant_name, merchant_name AS clean_merchant_name,
  payment_channel, pending AS is_pending, category_id AS plaid_category_id,
  array_to_string(json_extract_string(category, '$[*]'), ' > ') AS category_hierarchy,
  {js('personal_finance_category', '$.primary')} AS pfc_primary,
  {js('personal_finance_category', '$.detailed')} AS pfc_detailed,
  CASE WHEN amount > 0 THEN 'outflow' WHEN amount < 0 THEN 'inflow' ELSE 'zero' END AS flow_direction,
  _loaded_at, 'plaid' AS source_system
FROM raw_plaid_transactions WHERE pending = false""")

cte("stg_plaid_balances", f"""
SELECT account_id AS plaid_account_id, CAST(current AS {M}) AS current_balance,
  CAST(available AS {M}) AS available_balance, CAST("limit" AS {M}) AS credit_limit,
  upper(iso_currency_code) AS currency_code, snapshot_date AS balance_date, _loaded_at, 'plaid' AS source_system
FROM raw_plaid_balances""")

cte("stg_sf_accounts", f"""
SELECT id AS sf_account_id, name AS company_name, type AS account_type, industry,
  CAST(annual_revenue AS {M}) AS annual_revenue, number_of_employees AS employee_count, billing_street,
  billing_city, billing_state, billing_postal_code, billing_country, phone, website, owner_id,
  CAST(created_date AS TIMESTAMP) AS created_at, CAST(last_modified_date AS TIMESTAMP) AS updated_at,
  _loaded_at, 'salesforce' AS source_system
FROM raw_sf_accounts WHERE is_deleted = false""")

cte("stg_sf_opportunities", f"""
SELECT id AS opportunity_id, account_id AS sf_account_id, name AS opportunity_name, stage_name AS stage,
  CAST(amount AS {M}) AS amount, upper(coalesce(currency_iso_code, 'USD')) AS currency_code,
  CAST(probability / 100 AS DECIMAL(18,6)) AS probability, close_date, type AS opportunity_type,
  is_won, is_closed, fiscal_year, fiscal_quarter, owner_id,
  CAST(created_date AS TIMESTAMP) AS created_at, CAST(last_modified_date AS TIMESTAMP) AS updated_at,
  _loaded_at, 'salesforce' AS source_system
FROM raw_sf_opportunities WHERE is_deleted = false""")

# ---------------------------------------------------------------------------
# Intermediate
# ---------------------------------------------------------------------------
cte("golden_customers", f"""
SELECT {sk("coalesce(m.salesforce_account_id, '')", "coalesce(m.netsuite_customer_id, '')",
          "coalesce(m.quickbooks_customer_id, '')", "coalesce(m.stripe_customer_id, '')")} AS customer_golden_id,
  m.stripe_customer_id, m.quickbooks_customer_id, m.netsuite_customer_id, m.salesforce_account_id,
  coalesce(sf.company_name, qb.company_name, sc.customer_name) AS company_name,
  coalesce(qb.first_name, split(sc.customer_name, ' ')[1]) AS first_name,
  coalesce(qb.last_name, CASE WHEN len(split(sc.customer_name, ' ')) >= 2 THEN split(sc.customer_name, ' ')[2] END)
    AS last_name,
  coalesce(lower(trim(qb.email)), lower(trim(sc.email))) AS email,
  coalesce(qb.phone, sf.phone, sc.phone) AS phone,
  sf.website AS website,
  coalesce(sf.billing_street, qb.billing_address_line1, sc.address_line1) AS billing_address,
  coalesce(sf.billing_city, qb.billing_city, sc.city) AS billing_city,
  coalesce(sf.billing_state, qb.billing_state, sc.state) AS billing_state,
  coalesce(sf.billing_postal_code, qb.billing_postal_code, sc.postal_code) AS billing_postal_code,
  coalesce(sf.billing_country, qb.billing_country, sc.country) AS billing_country,
  sf.industry, sf.annual_revenue, sf.employee_count, sf.account_type AS customer_segment,
  coalesce(qb.is_active, true) AS is_active_accounting,
  coalesce(sc.is_delinquent, false) AS is_delinquent,
  least(coalesce(sf.created_at, TIMESTAMP '2099-01-01'), coalesce(qb.created_at, TIMESTAMP '2099-01-01'),
        coalesce(sc.created_at, TIMESTAMP '2099-01-01')) AS first_seen_at,
  greatest(coalesce(sf.updated_at, TIMESTAMP '2000-01-01'), coalesce(qb.updated_at, TIMESTAMP '2000-01-01'),
           coalesce(sc.created_at, TIMESTAMP '2000-01-01')) AS updated_at,
  CASE WHEN sf.sf_account_id IS NOT NULL THEN 'salesforce' WHEN qb.customer_id IS NOT NULL THEN 'quickbooks'
       WHEN sc.stripe_customer_id IS NOT NULL THEN 'stripe' END AS primary_source,
  (sf.sf_account_id IS NOT NULL) AND (qb.customer_id IS NOT NULL OR sc.stripe_customer_id IS NOT NULL)
    AS is_multi_source_match,
  {RUN_TS} AS _golden_record_updated_at
FROM (
  SELECT stripe_customer_id, quickbooks_customer_id, netsuite_customer_id, salesforce_account_id
  FROM stg_stripe_customers WHERE stripe_customer_id IS NOT NULL
  UNION ALL
  SELECT sc.stripe_customer_id, qb.customer_id, sc.netsuite_customer_id, sc.salesforce_account_id
  FROM stg_qb_customers qb JOIN stg_stripe_customers sc ON lower(trim(qb.email)) = lower(trim(sc.email))
  WHERE qb.email IS NOT NULL AND sc.email IS NOT NULL
    AND qb.customer_id NOT IN (SELECT quickbooks_customer_id FROM stg_stripe_customers
                               WHERE stripe_customer_id IS NOT NULL AND quickbooks_customer_id IS NOT NULL)
) m
LEFT JOIN stg_stripe_customers sc ON m.stripe_customer_id = sc.stripe_customer_id
LEFT JOIN stg_qb_customers qb ON m.quickbooks_customer_id = qb.customer_id
LEFT JOIN stg_sf_accounts sf ON m.salesforce_account_id = sf.sf_account_id""")

cte("unified_transactions", f"""
SELECT *, {RUN_TS} AS _unified_at FROM (
  SELECT {sk('invoice_id', "'qb_invoice'")} AS transaction_unified_id, invoice_id AS source_transaction_id,
    'invoice' AS transaction_type, 'accounts_receivable' AS transaction_category, customer_id AS source_entity_id,
    'customer' AS entity_type, CAST(total_amount AS {B}) AS amount, currency_code, invoice_date AS transaction_date,
    payment_status AS status, invoice_number AS reference_number, CAST(NULL AS VARCHAR) AS memo, created_at,
    source_system, _loaded_at
  FROM stg_qb_invoices
  UNION ALL
  SELECT {sk('payment_id', "'qb_payment'")}, payment_id, 'payment_received', 'cash_receipt', customer_id, 'customer',
    CAST(payment_amount AS {B}), currency_code, payment_date, 'completed', NULL, NULL, created_at, source_system,
    _loaded_at
  FROM stg_qb_payments
  UNION ALL
  SELECT {sk('charge_id', "'stripe_charge'")}, charge_id, 'payment_received', 'cash_receipt', stripe_customer_id,
    'customer', CAST(charge_amount AS {B}), currency_code, CAST(created_at AS DATE), charge_status,
    external_order_id, description, created_at, source_system, _loaded_at
  FROM stg_stripe_charges WHERE is_paid = true
  UNION ALL
  SELECT {sk('transaction_id', "'ns_txn'")}, transaction_id, transaction_type,
    CASE WHEN transaction_type IN ('CustInvc', 'CustCred') THEN 'accounts_receivable'
         WHEN transaction_type IN ('VendBill', 'VendCred') THEN 'accounts_payable'
         WHEN transaction_type = 'Journal' THEN 'journal_entry'
         WHEN transaction_type IN ('CustPymt', 'VendPymt') THEN 'cash_receipt' ELSE 'other' END,
    entity_id,
    CASE WHEN transaction_type LIKE 'Cust%' THEN 'customer' WHEN transaction_type LIKE 'Vend%' THEN 'vendor'
         ELSE 'other' END,
    CAST(total_amount_base AS {B}), 'USD', transaction_date, transaction_status, transaction_number, memo,
    created_at, source_system, _loaded_at
  FROM stg_ns_transactions WHERE is_posting = true
  UNION ALL
  SELECT {sk('plaid_transaction_id', "'plaid_txn'")}, plaid_transaction_id, 'bank_transaction',
    CASE WHEN flow_direction = 'inflow' THEN 'cash_receipt' WHEN flow_direction = 'outflow' THEN 'cash_disbursement'
         ELSE 'other' END,
    plaid_account_id, 'bank_account', CAST(amount AS {B}), currency_code, transaction_date, 'posted', NULL,
    merchant_name, _loaded_at, source_system, _loaded_at
  FROM stg_plaid_transactions) u""")

_coa_rows = ",\n".join(
    "('{}', '{}', '{}', '{}', '{}', {}, {})".format(*r[:5], str(r[5]).lower(), str(r[6]).lower())
    for r in __import__("ledgerlake.sources.seeds", fromlist=["x"]).CHART_OF_ACCOUNTS
)
cte("seed_chart_of_accounts", f"""
SELECT * FROM (VALUES {_coa_rows}) t(account_code, source_system, canonical_classification, canonical_category,
  financial_statement_line, is_balance_sheet, is_income_statement)""")

cte("chart_of_accounts", f"""
SELECT u.account_golden_id, u.source_account_id, u.source_system, u.account_name, u.account_number, u.account_type,
  u.account_sub_type, coalesce(c.canonical_classification, u.classification) AS classification,
  coalesce(c.canonical_category, u.account_type) AS category,
  coalesce(c.financial_statement_line, 'Other') AS financial_statement_line,
  coalesce(c.is_balance_sheet, false) AS is_balance_sheet, coalesce(c.is_income_statement, false) AS is_income_statement,
  u.is_active, {RUN_TS} AS _golden_record_updated_at
FROM (
  SELECT {sk('account_id', "'quickbooks'")} AS account_golden_id, account_id AS source_account_id, account_name,
    account_number, account_type, account_sub_type, classification, is_active, source_system FROM stg_qb_accounts
  UNION ALL
  SELECT {sk('account_id', "'netsuite'")}, account_id, account_name, account_number, account_type, NULL,
    classification, is_active, source_system FROM stg_ns_accounts) u
LEFT JOIN seed_chart_of_accounts c ON u.account_number = c.account_code AND u.source_system = c.source_system""")

# ---------------------------------------------------------------------------
# Marts
# ---------------------------------------------------------------------------
cte("fct_transactions", f"""
SELECT t.transaction_unified_id AS transaction_key, t.source_transaction_id, cl.customer_golden_id AS customer_key,
  t.transaction_date AS date_key, t.transaction_date, t.transaction_type, t.transaction_category, t.entity_type,
  t.status, t.reference_number, t.memo, t.source_system, t.amount, t.currency_code,
  CAST(CASE WHEN t.transaction_category = 'cash_receipt' THEN t.amount ELSE 0 END AS {B}) AS cash_inflow,
  CAST(CASE WHEN t.transaction_category = 'cash_disbursement' THEN abs(t.amount) ELSE 0 END AS {B}) AS cash_outflow,
  CAST(CASE WHEN t.transaction_category = 'accounts_receivable' THEN t.amount ELSE 0 END AS {B}) AS revenue_amount,
  t.created_at AS transaction_created_at, t._unified_at
FROM unified_transactions t
LEFT JOIN (
  SELECT customer_golden_id, stripe_customer_id AS source_id, 'stripe' AS sys FROM golden_customers
    WHERE stripe_customer_id IS NOT NULL
  UNION ALL
  SELECT customer_golden_id, quickbooks_customer_id, 'quickbooks' FROM golden_customers
    WHERE quickbooks_customer_id IS NOT NULL
  UNION ALL
  SELECT customer_golden_id, netsuite_customer_id, 'netsuite' FROM golden_customers
    WHERE netsuite_customer_id IS NOT NULL) cl
  ON t.source_entity_id = cl.source_id AND t.source_system = cl.sys""")

cte("fct_revenue", f"""
SELECT *, year(revenue_date) AS revenue_year, quarter(revenue_date) AS revenue_quarter,
  month(revenue_date) AS revenue_month, {RUN_TS} AS _loaded_at
FROM (
  SELECT transaction_key, customer_key, transaction_date AS revenue_date, CAST(amount AS {B}) AS revenue_amount,
    currency_code, 'recognized' AS revenue_stage, source_system, reference_number
  FROM fct_transactions WHERE transaction_category = 'accounts_receivable' AND amount > 0
  UNION ALL
  SELECT {sk('opp.opportunity_id')}, gc.customer_golden_id, opp.close_date, CAST(opp.amount AS {B}),
    opp.currency_code,
    CASE WHEN opp.is_won THEN 'booked' WHEN opp.is_closed THEN 'lost' ELSE 'pipeline' END,
    'salesforce', opp.opportunity_name
  FROM stg_sf_opportunities opp LEFT JOIN golden_customers gc ON opp.sf_account_id = gc.salesforce_account_id) r""")

cte("fct_cash_flow", f"""
SELECT c.cash_flow_id, c.bank_account_id, c.cash_flow_date, c.amount, c.currency_code, c.inflow_amount,
  c.outflow_amount, CAST(c.inflow_amount - c.outflow_amount AS {B}) AS net_cash_flow, c.category, c.subcategory,
  c.counterparty, c.payment_channel, c.source_system, c.cash_flow_type,
  b.current_balance AS eod_balance, b.available_balance AS eod_available_balance,
  year(c.cash_flow_date) AS year, quarter(c.cash_flow_date) AS quarter, month(c.cash_flow_date) AS month,
  dayofweek(c.cash_flow_date) + 1 AS day_of_week, {RUN_TS} AS _loaded_at
FROM (
  SELECT plaid_transaction_id AS cash_flow_id, plaid_account_id AS bank_account_id, transaction_date AS cash_flow_date,
    CAST(amount AS {B}) AS amount, currency_code,
    CAST(CASE WHEN amount > 0 THEN amount ELSE 0 END AS {B}) AS inflow_amount,
    CAST(CASE WHEN amount < 0 THEN abs(amount) ELSE 0 END AS {B}) AS outflow_amount,
    pfc_primary AS category, pfc_detailed AS subcategory, clean_merchant_name AS counterparty, payment_channel,
    'plaid' AS source_system, 'bank_transaction' AS cash_flow_type
  FROM stg_plaid_transactions
  UNION ALL
  SELECT balance_transaction_id, NULL, CAST(created_at AS DATE), CAST(net_amount AS {B}), currency_code,
    CAST(CASE WHEN net_amount > 0 THEN net_amount ELSE 0 END AS {B}),
    CAST(CASE WHEN net_amount < 0 THEN abs(net_amount) ELSE 0 END AS {B}),
    transaction_type, NULL, 'Stripe', 'electronic', 'stripe', 'payment_processor'
  FROM stg_stripe_balance_transactions WHERE transaction_type IN ('payout', 'charge', 'refund')) c
LEFT JOIN stg_plaid_balances b ON c.bank_account_id = b.plaid_account_id AND c.cash_flow_date = b.balance_date""")

_dpd = f"date_diff('day', i.due_date, {AS_OF})"
cte("fct_accounts_receivable", f"""
SELECT i.invoice_id, gc.customer_golden_id AS customer_key, i.invoice_number, i.invoice_date, i.due_date,
  i.total_amount, i.balance_due, CAST(i.total_amount - i.balance_due AS {M}) AS amount_paid, i.payment_status,
  i.currency_code, {_dpd} AS days_past_due,
  CASE WHEN i.balance_due = 0 THEN 'Paid' WHEN i.due_date >= {AS_OF} THEN 'Current'
       WHEN {_dpd} BETWEEN 1 AND 30 THEN '1-30 Days' WHEN {_dpd} BETWEEN 31 AND 60 THEN '31-60 Days'
       WHEN {_dpd} BETWEEN 61 AND 90 THEN '61-90 Days' ELSE '90+ Days' END AS aging_bucket,
  CASE WHEN i.balance_due = 0 THEN 0 WHEN i.due_date >= {AS_OF} THEN 1
       WHEN {_dpd} BETWEEN 1 AND 30 THEN 2 WHEN {_dpd} BETWEEN 31 AND 60 THEN 3
       WHEN {_dpd} BETWEEN 61 AND 90 THEN 4 ELSE 5 END AS aging_bucket_sort,
  i.source_system, {RUN_TS} AS _loaded_at
FROM stg_qb_invoices i LEFT JOIN golden_customers gc ON i.customer_id = gc.quickbooks_customer_id""")

cte("dim_customers", f"""
SELECT g.customer_golden_id AS customer_key, g.stripe_customer_id, g.quickbooks_customer_id, g.netsuite_customer_id,
  g.salesforce_account_id, g.company_name, g.first_name, g.last_name, g.email, g.phone, g.website,
  g.billing_address, g.billing_city, g.billing_state, g.billing_postal_code, g.billing_country, g.industry,
  g.customer_segment, g.annual_revenue, g.employee_count, g.is_active_accounting, g.is_delinquent,
  g.is_multi_source_match, g.primary_source,
  coalesce(tm.lifetime_transaction_count, 0) AS lifetime_transaction_count,
  CAST(coalesce(tm.lifetime_transaction_value, 0) AS {B}) AS lifetime_transaction_value,
  CAST(coalesce(tm.lifetime_revenue, 0) AS {B}) AS lifetime_revenue,
  tm.first_transaction_date, tm.last_transaction_date, tm.source_system_count,
  CASE WHEN coalesce(tm.lifetime_revenue, 0) >= 100000 THEN 'Enterprise'
       WHEN coalesce(tm.lifetime_revenue, 0) >= 25000 THEN 'Mid-Market'
       WHEN coalesce(tm.lifetime_revenue, 0) >= 5000 THEN 'SMB'
       WHEN coalesce(tm.lifetime_revenue, 0) > 0 THEN 'Starter' ELSE 'Prospect' END AS customer_tier,
  g.first_seen_at, g.updated_at, {RUN_TS} AS _dim_updated_at
FROM golden_customers g
LEFT JOIN (
  SELECT customer_key, count(DISTINCT transaction_key) AS lifetime_transaction_count,
    CAST(sum(amount) AS {B}) AS lifetime_transaction_value, CAST(sum(revenue_amount) AS {B}) AS lifetime_revenue,
    min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
    count(DISTINCT source_system) AS source_system_count
  FROM fct_transactions WHERE customer_key IS NOT NULL GROUP BY 1) tm
ON g.customer_golden_id = tm.customer_key""")

cte("dim_accounts", """
SELECT account_golden_id AS account_key, source_account_id, source_system, account_name, account_number,
  account_type, account_sub_type, classification, category, financial_statement_line, is_balance_sheet,
  is_income_statement, is_active, _golden_record_updated_at AS _dim_updated_at
FROM chart_of_accounts""")

cte("dim_date", f"""
SELECT d AS date_key, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
  CAST(strftime(d, '%U') AS INTEGER) AS week_of_year, dayofweek(d) + 1 AS day_of_week, dayofyear(d) AS day_of_year,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short, strftime(d, '%A') AS day_name,
  strftime(d, '%a') AS day_name_short, strftime(d, '%Y-%m') AS year_month,
  CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
  year(d) AS fiscal_year, quarter(d) AS fiscal_quarter, dayofweek(d) IN (0, 6) AS is_weekend,
  d = {AS_OF} AS is_today, date_diff('day', d, {AS_OF}) AS days_ago,
  (year({AS_OF}) * 12 + month({AS_OF})) - (year(d) * 12 + month(d)) AS months_ago
FROM (SELECT CAST(range AS DATE) AS d FROM range(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) s""")

# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
cte("daily_totals_by_source", f"""
SELECT transaction_date, source_system, transaction_category, count(*) AS transaction_count,
  CAST(sum(amount) AS {B}) AS total_amount,
  CAST(sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS {B}) AS total_debits,
  CAST(sum(CASE WHEN amount < 0 THEN abs(amount) ELSE 0 END) AS {B}) AS total_credits
FROM unified_transactions WHERE transaction_date >= {AS_OF} - 90 GROUP BY 1, 2, 3""")

cte("reconciliation_all", f"""
SELECT transaction_date, transaction_category, accounting_total, bank_total, stripe_total,
  CAST(accounting_total - bank_total AS {B}) AS accounting_bank_variance,
  CAST(abs(accounting_total - bank_total) AS {B}) AS absolute_variance,
  CASE WHEN bank_total = 0 AND accounting_total = 0 THEN 0.0 WHEN bank_total = 0 THEN 100.0
       ELSE round(CAST(abs(accounting_total - bank_total) AS DOUBLE) / CAST(abs(bank_total) AS DOUBLE) * 100, 2)
  END AS variance_pct,
  CASE WHEN abs(accounting_total - bank_total) < 1 THEN 'match'
       WHEN abs(accounting_total - bank_total) < 100 THEN 'minor_variance'
       WHEN abs(accounting_total - bank_total) < 1000 THEN 'notable_variance' ELSE 'critical_variance' END
    AS reconciliation_status,
  {RUN_TS} AS _checked_at
FROM (
  SELECT transaction_date, transaction_category,
    CAST(sum(CASE WHEN source_system IN ('quickbooks', 'netsuite') THEN total_amount ELSE 0 END) AS {B})
      AS accounting_total,
    CAST(sum(CASE WHEN source_system = 'plaid' THEN total_amount ELSE 0 END) AS {B}) AS bank_total,
    CAST(sum(CASE WHEN source_system = 'stripe' THEN total_amount ELSE 0 END) AS {B}) AS stripe_total
  FROM daily_totals_by_source WHERE transaction_category IN ('cash_receipt', 'cash_disbursement') GROUP BY 1, 2) a""")

cte("golden_record_completeness", f"""
SELECT *, round(fields_populated / total_fields * 100, 1) AS completeness_pct,
  CASE WHEN fields_populated >= 9 THEN 'excellent' WHEN fields_populated >= 7 THEN 'good'
       WHEN fields_populated >= 5 THEN 'fair' ELSE 'poor' END AS completeness_grade,
  {RUN_TS} AS _checked_at
FROM (
  SELECT customer_key, company_name, customer_tier, primary_source,
    (CASE WHEN company_name IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN email IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN phone IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN billing_address IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN billing_city IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN billing_state IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN billing_postal_code IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN billing_country IS NOT NULL THEN 1 ELSE 0 END)
    + (CASE WHEN industry IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN customer_segment IS NOT NULL THEN 1 ELSE 0 END)
      AS fields_populated,
    10 AS total_fields,
    company_name IS NOT NULL AS has_company_name, email IS NOT NULL AS has_email, phone IS NOT NULL AS has_phone,
    billing_address IS NOT NULL AS has_address, billing_city IS NOT NULL AS has_city,
    billing_state IS NOT NULL AS has_state, billing_postal_code IS NOT NULL AS has_postal_code,
    billing_country IS NOT NULL AS has_country, industry IS NOT NULL AS has_industry,
    customer_segment IS NOT NULL AS has_segment, is_multi_source_match AS has_cross_system_match
  FROM dim_customers) s""")

_hrs = f"date_sub('hour', last_record_at, {RUN_TS})"
cte("source_freshness", f"""
SELECT source_system, last_record_at, most_recent_transaction_date, total_records, records_last_7_days,
  records_last_24_hours, {_hrs} AS hours_since_last_load,
  CASE source_system WHEN 'stripe' THEN 6 WHEN 'plaid' THEN 24 WHEN 'quickbooks' THEN 12 WHEN 'netsuite' THEN 12
       WHEN 'salesforce' THEN 12 END AS sla_hours,
  CASE WHEN {_hrs} <= CASE source_system WHEN 'stripe' THEN 6 WHEN 'plaid' THEN 24 ELSE 12 END THEN 'healthy'
       WHEN {_hrs} <= CASE source_system WHEN 'stripe' THEN 12 WHEN 'plaid' THEN 48 ELSE 24 END THEN 'warning'
       ELSE 'critical' END AS freshness_status,
  {RUN_TS} AS _checked_at
FROM (
  SELECT source_system, max(_unified_at) AS last_record_at, max(transaction_date) AS most_recent_transaction_date,
    count(*) AS total_records,
    count(CASE WHEN transaction_date >= {AS_OF} - 7 THEN 1 END) AS records_last_7_days,
    count(CASE WHEN transaction_date >= {AS_OF} - 1 THEN 1 END) AS records_last_24_hours
  FROM unified_transactions GROUP BY 1) f""")

cte("daily_stats", f"""
SELECT transaction_date, source_system, count(*) AS daily_count, CAST(sum(amount) AS {B}) AS daily_total,
  avg(CAST(amount AS DOUBLE)) AS daily_avg_amount, max(amount) AS daily_max_amount
FROM unified_transactions WHERE transaction_date >= {AS_OF} - 120 GROUP BY 1, 2""")

_w = "OVER (PARTITION BY source_system ORDER BY transaction_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"
cte("anomalies_all", f"""
SELECT transaction_date, source_system, daily_count, daily_total,
  round(ac, 6) AS rolling_avg_count, round(sc, 6) AS rolling_stddev_count,
  round(avg_t, 6) AS rolling_avg_total, round(sd_t, 6) AS rolling_stddev_total,
  CASE WHEN sc > 0 THEN round((daily_count - ac) / sc, 2) ELSE 0.0 END AS count_z_score,
  CASE WHEN sd_t > 0 THEN round((td - avg_t) / sd_t, 2) ELSE 0.0 END AS amount_z_score,
  coalesce(sc > 0 AND abs(daily_count - ac) > 2 * sc, false) AS is_count_anomaly,
  coalesce(sd_t > 0 AND abs(td - avg_t) > 2 * sd_t, false) AS is_amount_anomaly,
  {RUN_TS} AS _checked_at
FROM (
  SELECT *, CAST(daily_total AS DOUBLE) AS td,
    avg(CAST(daily_count AS DOUBLE)) {_w} AS ac, stddev_samp(CAST(daily_count AS DOUBLE)) {_w} AS sc,
    avg(CAST(daily_total AS DOUBLE)) {_w} AS avg_t, stddev_samp(CAST(daily_total AS DOUBLE)) {_w} AS sd_t
  FROM daily_stats) r
WHERE transaction_date >= {AS_OF} - 90""")


# ---------------------------------------------------------------------------
def sql(final: str) -> str:
    """Prefix ``final`` with the CTEs it (transitively) references."""
    names = list(CTES)
    pat = {n: re.compile(rf"\b{re.escape(n)}\b") for n in names}
    need: set[str] = set()

    def visit(text: str, upto: int | None = None):
        for i, n in enumerate(names[:upto]):
            if n not in need and pat[n].search(text):
                need.add(n)
                visit(CTES[n], i)

    visit(final)
    ordered = [n for n in names if n in need]
    if not ordered:
        return final
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    body = final.lstrip()
    if body[:4].upper() == "WITH":  # merge the final statement's own CTEs
        return head + ",\n" + body[4:]
    return head + "\n" + final


# ---------------------------------------------------------------------------
# NetSuite system-side tables (for the pulls S9-S11)
# ---------------------------------------------------------------------------
cte("ns_system_transactions", f"""
SELECT id, 'NS-' || id AS tranId, CASE WHEN l_returnflag = 'R' THEN 'Journal' ELSE 'CustInvc' END AS type,
  l_linestatus AS status, 'NS-' || {s('l_partkey')} AS entity, '1' AS subsidiary, {s('l_suppkey % 5')} AS department,
  '1' AS currency, CAST(1 + l_tax AS DECIMAL(18,9)) AS exchangeRate, CAST(l_extendedprice AS {M}) AS total,
  d AS tranDate, d + 30 AS dueDate, l_linenumber <> 2 AS posting, false AS voided,
  'line ' || {s('l_linenumber')} AS memo, CAST(d AS TIMESTAMP) AS dateCreated, CAST(d AS TIMESTAMP) AS lastModifiedDate
FROM (SELECT *, {s('l_orderkey')} || '-' || {s('l_linenumber')} || '-' || {s('l_partkey')} || '-' || {s('l_suppkey')} || '-' || strftime(l_shipdate, '%Y%m%d') AS id, {shifted('l_shipdate')} AS d FROM lineitem) li""")

cte("ns_system_lines", f"""
SELECT transaction, seq AS lineSequenceNumber, CASE WHEN seq = 1 THEN '1100' ELSE '4000' END AS account,
  CAST(CASE WHEN seq = 1 THEN amt ELSE -cr END AS {M}) AS amount,
  CAST(CASE WHEN seq = 1 THEN amt END AS {M}) AS debit, CAST(CASE WHEN seq = 2 THEN cr END AS {M}) AS credit,
  department, CAST(NULL AS VARCHAR) AS class, CAST(NULL AS VARCHAR) AS location, 'item ' || acct AS memo
FROM (SELECT {s('l_orderkey')} || '-' || {s('l_linenumber')} || '-' || {s('l_partkey')} || '-' || {s('l_suppkey')} || '-' || strftime(l_shipdate, '%Y%m%d') AS transaction, CAST(l_extendedprice AS {M}) AS amt,
        CASE WHEN l_orderkey % 97 = 0 THEN CAST(CAST(l_extendedprice AS {M}) - 1 AS {M})
             ELSE CAST(l_extendedprice AS {M}) END AS cr,
        {s('l_suppkey % 5')} AS department, {s('l_partkey')} AS acct
      FROM lineitem) b, (SELECT unnest([1, 2]) AS seq) q""")

cte("ns_system_customers", f"""
SELECT 'NS-' || {s('c_custkey')} AS id, 'CUST' || {s('c_custkey')} AS entityId, c_name AS companyName,
  'c' || {s('c_custkey')} || '@ex.com' AS email, CAST(NULL AS VARCHAR) AS phone, c_acctbal < 0 AS isInactive,
  {epoch_ts('1483228800 + (c_custkey % 10000) * 3600')} AS dateCreated
FROM customer""")

cte("ns_system_vendors", f"""
SELECT 'VEND-' || {s('s_suppkey')} AS id, 'VEND' || {s('s_suppkey')} AS entityId, s_name AS companyName,
  CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone, s_acctbal < 0 AS isInactive,
  {epoch_ts('1483228800 + (s_suppkey % 10000) * 3600')} AS dateCreated
FROM supplier""")

cte("ns_system_accounts", """
SELECT id, acct_name AS acctName, acct_number AS acctNumber, acct_type AS acctType, general_rate_type AS generalRateType,
  parent, is_inactive AS isInactive FROM raw_ns_accounts""")

cte("ns_system_subsidiaries", f"""
SELECT {s('n_nationkey')} AS id, n_name AS name, 'R' || {s('n_regionkey')} AS country, 'USD' AS currency,
  false AS isInactive FROM nation""")

cte("ns_system_departments", f"""
SELECT {s('r_regionkey')} AS id, r_name AS name, CAST(NULL AS VARCHAR) AS parent, false AS isInactive FROM region""")
