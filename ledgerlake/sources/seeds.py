"""Reference seeds (S13): chart-of-accounts mapping and currency codes.

Read from CSV with a pinned schema when a path is given; otherwise built from
the fixed values below (the same rows as the shipped seed files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

CHART_SCHEMA = StructType([
    StructField("account_code", StringType()),
    StructField("source_system", StringType()),
    StructField("canonical_classification", StringType()),
    StructField("canonical_category", StringType()),
    StructField("financial_statement_line", StringType()),
    StructField("is_balance_sheet", BooleanType()),
    StructField("is_income_statement", BooleanType()),
])

CURRENCY_SCHEMA = StructType([
    StructField("currency_code", StringType()),
    StructField("currency_name", StringType()),
    StructField("symbol", StringType()),
    StructField("decimal_places", IntegerType()),
])

# Canonical chart of accounts
# (account_code, source_system, classification, category, statement line, balance sheet, income statement)
CHART_OF_ACCOUNTS = [
    ("1000", "quickbooks", "Asset", "Cash and Equivalents", "Cash and Cash Equivalents", True, False),
    ("1100", "quickbooks", "Asset", "Accounts Receivable", "Accounts Receivable", True, False),
    ("1200", "quickbooks", "Asset", "Other Current Assets", "Prepaid Expenses", True, False),
    ("1500", "quickbooks", "Asset", "Fixed Assets", "Property and Equipment", True, False),
    ("2000", "quickbooks", "Liability", "Accounts Payable", "Accounts Payable", True, False),
    ("2100", "quickbooks", "Liability", "Short-term Debt", "Accrued Liabilities", True, False),
    ("2500", "quickbooks", "Liability", "Long-term Debt", "Long-term Debt", True, False),
    ("3000", "quickbooks", "Equity", "Equity", "Retained Earnings", True, False),
    ("4000", "quickbooks", "Revenue", "Revenue", "Revenue", False, True),
    ("4100", "quickbooks", "Revenue", "Other Income", "Other Income", False, True),
    ("5000", "quickbooks", "Expense", "Cost of Goods Sold", "Cost of Revenue", False, True),
    ("6000", "quickbooks", "Expense", "Operating Expenses", "Sales and Marketing", False, True),
    ("6100", "quickbooks", "Expense", "Operating Expenses", "General and Administrative", False, True),
    ("6200", "quickbooks", "Expense", "Operating Expenses", "Research and Development", False, True),
    ("7000", "quickbooks", "Expense", "Other Expenses", "Interest Expense", False, True),
    ("1000", "netsuite", "Asset", "Cash and Equivalents", "Cash and Cash Equivalents", True, False),
    ("1100", "netsuite", "Asset", "Accounts Receivable", "Accounts Receivable", True, False),
    ("2000", "netsuite", "Liability", "Accounts Payable", "Accounts Payable", True, False),
    ("3000", "netsuite", "Equity", "Equity", "Retained Earnings", True, False),
    ("4000", "netsuite", "Revenue", "Revenue", "Revenue", False, True),
    ("5000", "netsuite", "Expense", "Cost of Goods Sold", "Cost of Revenue", False, True),
    ("6000", "netsuite", "Expense", "Operating Expenses", "Operating Expenses", False, True),
]

# Currency codes (code, name, symbol, decimal places)
CURRENCY_CODES = [
    ("USD", "US Dollar", "$", 2),
    ("EUR", "Euro", "€", 2),
    ("GBP", "British Pound", "£", 2),
    ("CAD", "Canadian Dollar", "C$", 2),
    ("AUD", "Australian Dollar", "A$", 2),
    ("JPY", "Japanese Yen", "¥", 0),
    ("CHF", "Swiss Franc", "CHF", 2),
]


def _load(spark: SparkSession, rows, schema, path: str | None) -> DataFrame:
    if path:
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.createDataFrame(rows, schema)


def chart_of_accounts(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _load(spark, CHART_OF_ACCOUNTS, CHART_SCHEMA, path)


def currency_codes(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _load(spark, CURRENCY_CODES, CURRENCY_SCHEMA, path)
