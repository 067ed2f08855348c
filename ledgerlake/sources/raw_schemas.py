"""Explicit schemas of the 13 staged raw tables (landed JSON is read with
these instead of inference). JSON documents are kept as text (metadata,
address, categories); money is decimal(18,4), rates decimal(18,9), Stripe
amounts integer cents, epoch times seconds. Every table also carries
``_loaded_at`` (ISO-8601 text) and ``_source_system``."""

from __future__ import annotations

_STAMP = ", _loaded_at string, _source_system string"

RAW_SCHEMAS = {
    "quickbooks.accounts": "id string, name string, account_type string, account_sub_type string, acct_num string, "
                           "classification string, current_balance decimal(18,4), currency_ref_value string, "
                           "active boolean, meta_create_time string, meta_last_updated_time string",
    "quickbooks.customers": "id string, display_name string, company_name string, given_name string, "
                            "family_name string, primary_email_addr_address string, "
                            "primary_phone_free_form_number string, bill_addr_line1 string, bill_addr_city string, "
                            "bill_addr_country_sub_division_code string, bill_addr_postal_code string, "
                            "bill_addr_country string, active boolean, balance decimal(18,4), "
                            "currency_ref_value string, meta_create_time string, meta_last_updated_time string",
    "quickbooks.invoices": "id string, customer_ref_value string, doc_number string, total_amt decimal(18,4), "
                           "balance decimal(18,4), currency_ref_value string, txn_date date, due_date date, "
                           "email_status string, meta_create_time string, meta_last_updated_time string",
    "quickbooks.payments": "id string, customer_ref_value string, total_amt decimal(18,4), currency_ref_value string, "
                           "txn_date date, deposit_to_account_ref_value string, payment_method_ref_value string, "
                           "meta_create_time string, meta_last_updated_time string",
    "stripe.charges": "id string, customer string, amount bigint, amount_refunded bigint, currency string, "
                      "status string, paid boolean, refunded boolean, disputed boolean, payment_method string, "
                      "payment_method_details string, description string, invoice string, metadata string, "
                      "created bigint",
    "stripe.customers": "id string, name string, email string, phone string, address string, currency string, "
                        "delinquent boolean, metadata string, created bigint",
    "stripe.balance_transactions": "id string, amount bigint, fee bigint, net bigint, currency string, type string, "
                                   "status string, source string, description string, created bigint, "
                                   "available_on bigint",
    "netsuite.transactions": "id string, tran_id string, type string, status string, entity string, "
                             "subsidiary string, department string, currency string, exchange_rate decimal(18,9), "
                             "total decimal(18,4), tran_date date, due_date date, posting boolean, voided boolean, "
                             "memo string, date_created string, last_modified_date string",
    "netsuite.accounts": "id string, acct_name string, acct_number string, acct_type string, "
                         "general_rate_type string, parent string, is_inactive boolean",
    "plaid.transactions": "transaction_id string, account_id string, amount decimal(18,4), iso_currency_code string, "
                          "date date, authorized_date date, name string, merchant_name string, "
                          "payment_channel string, pending boolean, category_id string, category string, "
                          "personal_finance_category string",
    "plaid.balances": "account_id string, current decimal(18,4), available decimal(18,4), `limit` decimal(18,4), "
                      "iso_currency_code string, snapshot_date date",
    "salesforce.accounts": "id string, name string, type string, industry string, annual_revenue decimal(18,4), "
                           "number_of_employees bigint, billing_street string, billing_city string, "
                           "billing_state string, billing_postal_code string, billing_country string, phone string, "
                           "website string, owner_id string, created_date string, last_modified_date string, "
                           "is_deleted boolean",
    "salesforce.opportunities": "id string, account_id string, name string, stage_name string, amount decimal(18,4), "
                                "currency_iso_code string, probability decimal(18,4), close_date date, type string, "
                                "is_won boolean, is_closed boolean, fiscal_year bigint, fiscal_quarter bigint, "
                                "owner_id string, created_date string, last_modified_date string, is_deleted boolean",
}
RAW_SCHEMAS = {k: v + _STAMP for k, v in RAW_SCHEMAS.items()}
