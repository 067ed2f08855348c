"""Data-vault models M17-M25 over the staged tables and the unified spine.

Each function returns the rows to insert given the current target (``None``
on a first run = full build). ``deal_once`` (see ``vault``) is for a target that is no bucketed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import surrogate_key
from ledgerlake.operators import vault

# Fixed value: the accounts-receivable account number customers link to
AR_ACCOUNT_NUMBER = "1100"


def hub_customer(qb: DataFrame, stripe: DataFrame, sf: DataFrame, target: DataFrame | None = None):  # M17
    return vault.hub(
        [(qb, "customer_id", "quickbooks", "_loaded_at"),
         (stripe, "stripe_customer_id", "stripe", "_loaded_at"),
         (sf, "sf_account_id", "salesforce", "_loaded_at")],
        "hub_customer_hk", "customer_bk", target)


def hub_account(qb_accounts: DataFrame, ns_accounts: DataFrame, target: DataFrame | None = None):  # M18
    return vault.hub(
        [(qb_accounts, "account_id", "quickbooks", "_loaded_at"),
         (ns_accounts, "account_id", "netsuite", "_loaded_at")],
        "hub_account_hk", "account_bk", target)


def hub_transaction(utx: DataFrame, target: DataFrame | None = None, deal_once: bool = False):  # M19
    return vault.hub([(utx, "transaction_unified_id", "@source_system", "_unified_at")],
                     "hub_transaction_hk", "transaction_bk", target, deal_once=deal_once)


def lnk_customer_account(invoices: DataFrame, target: DataFrame | None = None,
                         account_key: str = AR_ACCOUNT_NUMBER):  # M20
    # D7 kept: the account side hashes the account *number*, as the reference does
    rel = invoices.filter(F.col("customer_id").isNotNull())
    return vault.link(
        rel, "lnk_customer_account_hk",
        {"hub_customer_hk": surrogate_key("customer_id", F.lit("quickbooks")),
         "hub_account_hk": surrogate_key(F.lit(account_key), F.lit("quickbooks"))},
        F.lit("quickbooks"), F.col("_loaded_at"), target)


def lnk_transaction_account(utx: DataFrame, target: DataFrame | None = None, deal_once: bool = False):  # M21
    # D7 kept: the account side hashes the transaction's entity id
    rel = utx.filter(F.col("source_entity_id").isNotNull())
    return vault.link(
        rel, "lnk_transaction_account_hk",
        {"hub_transaction_hk": surrogate_key("transaction_unified_id", "source_system"),
         "hub_account_hk": surrogate_key("source_entity_id", "source_system")},
        F.col("source_system"), F.col("_unified_at"), target, deal_once=deal_once)


def _payload(names):
    return {n: F.col(n) for n in names}


def sat_customer_details(qb: DataFrame, target: DataFrame | None = None, compare: str = "any"):  # M22
    hash_cols = ["display_name", "company_name", "first_name", "last_name", "email", "phone",
                 "billing_address_line1", "billing_city", "billing_state", "billing_postal_code", "is_active",
                 "outstanding_balance"]
    payload = _payload(["display_name", "company_name", "first_name", "last_name", "email", "phone",
                        "billing_address_line1", "billing_city", "billing_state", "billing_postal_code",
                        "billing_country", "is_active", "outstanding_balance", "currency_code"])
    return vault.satellite(qb, "sat_customer_details_hk", surrogate_key("customer_id", F.lit("quickbooks")),
                           "hub_customer_hk", hash_cols, payload, F.lit("quickbooks"), F.col("_loaded_at"),
                           target, compare)


def sat_customer_stripe(stripe: DataFrame, target: DataFrame | None = None, compare: str = "any"):  # M23
    hash_cols = ["customer_name", "email", "phone", "city", "state", "is_delinquent", "quickbooks_customer_id",
                 "netsuite_customer_id", "salesforce_account_id"]
    payload = _payload(["customer_name", "email", "phone", "address_line1", "city", "state", "postal_code",
                        "country", "currency_code", "is_delinquent"])
    payload.update({"xref_quickbooks_id": F.col("quickbooks_customer_id"),
                    "xref_netsuite_id": F.col("netsuite_customer_id"),
                    "xref_salesforce_id": F.col("salesforce_account_id")})
    return vault.satellite(stripe, "sat_customer_stripe_hk", surrogate_key("stripe_customer_id", F.lit("stripe")),
                           "hub_customer_hk", hash_cols, payload, F.lit("stripe"), F.col("_loaded_at"),
                           target, compare)


def sat_account_balance(qb_accounts: DataFrame, target: DataFrame | None = None, compare: str = "any"):  # M24
    payload = _payload(["account_name", "current_balance", "currency_code", "is_active"])
    return vault.satellite(qb_accounts, "sat_account_balance_hk", surrogate_key("account_id", F.lit("quickbooks")),
                           "hub_account_hk", ["current_balance", "is_active"], payload, F.lit("quickbooks"),
                           F.col("_loaded_at"), target, compare)


def sat_transaction_details(utx: DataFrame, target: DataFrame | None = None, compare: str = "any",
                            deal_once: bool = False):  # M25
    hash_cols = ["transaction_type", "transaction_category", "amount", "status", "reference_number", "memo"]
    payload = _payload(["transaction_type", "transaction_category", "amount", "currency_code", "transaction_date",
                        "status", "reference_number", "memo"])
    return vault.satellite(utx, "sat_transaction_details_hk",
                           surrogate_key("transaction_unified_id", "source_system"), "hub_transaction_hk",
                           hash_cols, payload, F.col("source_system"), F.col("_unified_at"), target, compare,
                           deal_once=deal_once)
