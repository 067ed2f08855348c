"""The declared column/table checks of the models (2L), as data, and runners.

Mirrors the reference's YAML declarations: not_null, unique, accepted_values,
values-between (with optional where), regex match, row-count bounds,
relationships and composite uniqueness.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame

from ledgerlake.operators.checks import Check, run_model_checks
from ledgerlake.params import DEFAULT, RunParams
from ledgerlake.session import cut

EMAIL_REGEX = r"^[^@]+@[^@]+\.[^@]+$"

# Accepted-value lists of the declarations
PRIMARY_SOURCES = ["salesforce", "quickbooks", "stripe"]
CLASSIFICATIONS = ["Asset", "Liability", "Equity", "Revenue", "Expense", "Other"]
UTX_SOURCES = ["quickbooks", "stripe", "netsuite", "plaid"]
REVENUE_STAGES = ["recognized", "booked", "pipeline", "lost"]
AGING_BUCKETS = ["Paid", "Current", "1-30 Days", "31-60 Days", "61-90 Days", "90+ Days"]
TIERS = ["Enterprise", "Mid-Market", "SMB", "Starter", "Prospect"]
INVOICE_CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD"]
PAYMENT_STATUSES = ["paid", "open", "overdue"]
CHARGE_STATUSES = ["succeeded", "pending", "failed"]
BALANCE_TYPES = ["charge", "refund", "payout", "adjustment", "transfer", "stripe_fee", "application_fee", "payment"]
QB_CLASSIFICATIONS = ["Asset", "Equity", "Expense", "Liability", "Revenue"]


def _nn(c):
    return Check("not_null", c)


def _un(c):
    return Check("unique", c)


def suite(p: RunParams = DEFAULT) -> dict[str, list[Check]]:
    min_date = p.min_transaction_date
    return {
        "golden_customers": [
            _nn("customer_golden_id"), _un("customer_golden_id"), _nn("company_name"),
            Check("regex", "email", {"regex": EMAIL_REGEX, "where": "email is not null"}),
            Check("accepted_values", "primary_source", {"values": PRIMARY_SOURCES}),
            Check("row_count", None, {"min": 1}),
        ],
        "chart_of_accounts": [
            _nn("account_golden_id"), _un("account_golden_id"),
            Check("accepted_values", "classification", {"values": CLASSIFICATIONS}),
        ],
        "unified_transactions": [
            _nn("transaction_unified_id"), _un("transaction_unified_id"), _nn("source_system"),
            Check("accepted_values", "source_system", {"values": UTX_SOURCES}),
            _nn("amount"), _nn("transaction_date"),
            Check("between", "transaction_date", {"min": min_date, "max": p.as_of}),
            _nn("currency_code"),
        ],
        "fct_transactions": [
            _nn("transaction_key"), _un("transaction_key"),
            Check("relationships", "customer_key",
                  {"to": "dim_customers", "field": "customer_key", "where": "customer_key is not null"}),
            _nn("amount"), _nn("transaction_date"), _nn("source_system"),
            Check("row_count", None, {"min": 1}, severity="warn"),
        ],
        "fct_revenue": [
            _nn("transaction_key"), _nn("revenue_amount"),
            Check("between", "revenue_amount", {"min": 0, "where": "revenue_stage = 'recognized'"}),
            Check("accepted_values", "revenue_stage", {"values": REVENUE_STAGES}),
        ],
        "fct_cash_flow": [_nn("cash_flow_id"), _un("cash_flow_id"), _nn("cash_flow_date")],
        "fct_accounts_receivable": [
            _nn("invoice_id"), _un("invoice_id"),
            Check("accepted_values", "aging_bucket", {"values": AGING_BUCKETS}),
            Check("between", "total_amount", {"min": 0}), Check("between", "balance_due", {"min": 0}),
        ],
        "dim_customers": [
            _nn("customer_key"), _un("customer_key"), _nn("company_name"),
            Check("accepted_values", "customer_tier", {"values": TIERS}),
        ],
        "dim_accounts": [_nn("account_key"), _un("account_key"), _nn("classification")],
        "dim_date": [_nn("date_key"), _un("date_key")],
        "stg_qb_invoices": [
            _nn("invoice_id"), _un("invoice_id"), _nn("customer_id"), _nn("total_amount"),
            Check("between", "total_amount", {"min": 0, "max": 10000000}),
            _nn("currency_code"), Check("accepted_values", "currency_code", {"values": INVOICE_CURRENCIES}),
            Check("accepted_values", "payment_status", {"values": PAYMENT_STATUSES}),
        ],
        "stg_qb_payments": [
            _nn("payment_id"), _un("payment_id"), _nn("payment_amount"), Check("between", "payment_amount", {"min": 0}),
        ],
        "stg_qb_accounts": [
            _nn("account_id"), _un("account_id"), _nn("account_name"),
            Check("accepted_values", "classification", {"values": QB_CLASSIFICATIONS}),
        ],
        "stg_qb_customers": [
            _nn("customer_id"), _un("customer_id"),
            Check("regex", "email", {"regex": EMAIL_REGEX, "where": "email is not null"}),
        ],
        "stg_ns_transactions": [
            _nn("transaction_id"), _un("transaction_id"), _nn("transaction_type"), _nn("total_amount"),
        ],
        "stg_ns_accounts": [
            _nn("account_id"), _un("account_id"),
            Check("accepted_values", "classification", {"values": CLASSIFICATIONS}),
        ],
        "stg_stripe_charges": [
            _nn("charge_id"), _un("charge_id"), _nn("charge_amount"), Check("between", "charge_amount", {"min": 0}),
            Check("accepted_values", "charge_status", {"values": CHARGE_STATUSES}),
        ],
        "stg_stripe_customers": [_nn("stripe_customer_id"), _un("stripe_customer_id")],
        "stg_stripe_balance_transactions": [
            _nn("balance_transaction_id"), _un("balance_transaction_id"),
            Check("accepted_values", "transaction_type", {"values": BALANCE_TYPES}),
        ],
        "stg_sf_opportunities": [
            _nn("opportunity_id"), _un("opportunity_id"),
            Check("between", "amount", {"min": 0, "where": "is_won = true"}), _nn("stage"),
        ],
        "stg_sf_accounts": [_nn("sf_account_id"), _un("sf_account_id")],
        "stg_plaid_transactions": [
            _nn("plaid_transaction_id"), _un("plaid_transaction_id"), _nn("amount"), _nn("transaction_date"),
        ],
        "stg_plaid_balances": [
            _nn("plaid_account_id"), _nn("balance_date"),
            Check("unique_combination", None, {"columns": ["plaid_account_id", "balance_date"]}),
        ],
        # the raw tables' keys; quickbooks.bills is declared too, but no job reads it and it has no input here
        "raw_qb_accounts": [_nn("id"), _un("id")],
        "raw_qb_invoices": [_nn("id"), _un("id")],
        "raw_qb_payments": [_nn("id"), _un("id")],
        "raw_stripe_charges": [_nn("id"), _un("id")],
    }


def model_frames(m) -> dict[str, DataFrame]:
    return {
        "golden_customers": m.golden, "chart_of_accounts": m.chart_of_accounts, "unified_transactions": m.utx,
        "fct_transactions": m.fct_transactions, "fct_revenue": m.fct_revenue, "fct_cash_flow": m.fct_cash_flow,
        "fct_accounts_receivable": m.fct_accounts_receivable, "dim_customers": m.dim_customers,
        "dim_accounts": m.dim_accounts, "dim_date": m.dim_date, "stg_qb_invoices": m.stg.qb_invoices(),
        "stg_qb_payments": m.stg.qb_payments(), "stg_qb_accounts": m.stg.qb_accounts(),
        "stg_qb_customers": m.stg.qb_customers(), "stg_ns_transactions": m.stg.ns_transactions(),
        "stg_plaid_transactions": m.stg.plaid_transactions(), "stg_plaid_balances": m.stg.plaid_balances(),
        "stg_ns_accounts": m.stg.ns_accounts(), "stg_stripe_charges": m.stg.stripe_charges(),
        "stg_stripe_customers": m.stg.stripe_customers(),
        "stg_stripe_balance_transactions": m.stg.stripe_balance_transactions(),
        "stg_sf_opportunities": m.stg.sf_opportunities(), "stg_sf_accounts": m.stg.sf_accounts(),
        "raw_qb_accounts": m.raw("quickbooks.accounts"), "raw_qb_invoices": m.raw("quickbooks.invoices"),
        "raw_qb_payments": m.raw("quickbooks.payments"), "raw_stripe_charges": m.raw("stripe.charges"),
    }


# frames read by several scans of the checks that the Model does not already keep as tables; all checks
# of fct_revenue are one aggregate over one scan, so storing its rows first would only add a write and a read
MATERIALIZE = ["fct_cash_flow", "fct_accounts_receivable", "chart_of_accounts"]


def columns_of(checks: list[Check]) -> list[str] | None:
    """The columns that the checks look at; None if conditions name others."""
    if any(c.args.get("where") for c in checks):
        return None
    return list(dict.fromkeys(x for c in checks for x in ([c.column] if c.column else c.args.get("columns", []))))


def stored(m, s: dict[str, list[Check]]):
    """A copy of ``m`` whose MATERIALIZE frames are stored, but for the chart, which dim_accounts is made of,
    with the columns that their checks look at."""
    clone = m.materialize("chart_of_accounts")
    clone.fct_transactions  # from the spine's narrower plan, before model_frames makes the month table
    for name in MATERIALIZE:
        if name != "chart_of_accounts":
            df, columns = getattr(clone, name), columns_of(s[name])
            clone.__dict__[name] = cut(df.select(*columns) if columns else df)
    return clone


def run_suite(m, models: list[str] | None = None, materialize: bool = True) -> DataFrame:
    """Evaluate the suite. With ``materialize`` the upstream frames that several
    scans read are checkpointed once first, so their checks scan stored rows."""
    s = suite(m.p)
    if materialize:
        m = stored(m, s)
    frames = model_frames(m)
    parts = []
    for name in (models or list(s)):
        # one small job per model; its few result rows are stored, so the final
        # union is not one giant plan re-optimized after every stage
        res = run_model_checks(m.spark, name, frames[name], s[name], frames)
        parts.append(cut(res))
    return reduce(DataFrame.unionByName, parts)


def _fmt(v) -> str:
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    return repr(v)


def oracle_suite_sql(p: RunParams = DEFAULT, models: list[str] | None = None) -> str:
    """The same suite as DuckDB SQL (for the oracle)."""
    s = suite(p)
    selects = []
    for model in (models or list(s)):
        for c in s[model]:
            col = c.column
            if c.kind == "not_null":
                n = f"(SELECT count(*) FROM {model} WHERE {col} IS NULL)"
            elif c.kind == "unique":
                n = f"(SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
            elif c.kind == "accepted_values":
                vals = ", ".join(repr(v) for v in c.args["values"])
                n = f"(SELECT count(*) FROM {model} WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
            elif c.kind == "between":
                conds = []
                if c.args.get("min") is not None:
                    conds.append(f"{col} < {_fmt(c.args['min'])}")
                if c.args.get("max") is not None:
                    conds.append(f"{col} > {_fmt(c.args['max'])}")
                where = c.args.get("where") or "true"
                n = f"(SELECT count(*) FROM {model} WHERE ({where}) AND ({' OR '.join(conds)}))"
            elif c.kind == "regex":
                where = c.args.get("where") or "true"
                n = f"(SELECT count(*) FROM {model} WHERE ({where}) AND NOT regexp_matches({col}, '{c.args['regex']}'))"
            elif c.kind == "row_count":
                conds = []
                if c.args.get("min") is not None:
                    conds.append(f"count(*) < {c.args['min']}")
                if c.args.get("max") is not None:
                    conds.append(f"count(*) > {c.args['max']}")
                n = f"(SELECT CASE WHEN {' OR '.join(conds)} THEN 1 ELSE 0 END FROM {model})"
            elif c.kind == "relationships":
                parent, fld = c.args["to"], c.args["field"]
                n = (f"(SELECT count(*) FROM {model} WHERE ({c.args.get('where') or 'true'}) AND {col} IS NOT NULL "
                     f"AND {col} NOT IN (SELECT {fld} FROM {parent} WHERE {fld} IS NOT NULL))")
            elif c.kind == "unique_combination":
                cols = ", ".join(c.args["columns"])
                n = f"(SELECT count(*) FROM (SELECT {cols} FROM {model} GROUP BY ALL HAVING count(*) > 1))"
            else:
                raise ValueError(c.kind)
            colv = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
            fail_status = "warn" if c.severity == "warn" else "fail"
            selects.append(
                f"SELECT '{model}' AS model, '{c.kind}' AS \"check\", {colv} AS \"column\", "
                f"CASE WHEN {n} = 0 THEN 'pass' ELSE '{fail_status}' END AS status, CAST({n} AS BIGINT) AS failures"
            )
    return "\nUNION ALL\n".join(selects)
