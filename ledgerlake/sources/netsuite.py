"""NetSuite pulls S9-S11.

The extractor's SuiteQL statements are projections with renames, a date
filter and one parent-scoped join. Here they are DataFrame functions over
the system-side tables (camelCase columns), so the date filter and the
column pruning reach the scan. ``system_*`` builds those system-side tables
from the driver tables for tests and benchmarks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import MONEY, RATE
from ledgerlake.sources.driver_tables import SHIFT_DAYS, netsuite_accounts, netsuite_line_id

DEFAULT_MIN_DATE = dt.date(2020, 1, 1)


# ---------------------------------------------------------------------------
# Pulls
# ---------------------------------------------------------------------------
def pull_transactions(transaction: DataFrame, min_date=DEFAULT_MIN_DATE) -> DataFrame:  # S9
    c = F.col
    return transaction.filter(c("tranDate") >= F.lit(min_date)).select(
        "id", c("tranId").alias("tran_id"), "type", "status", "entity", "subsidiary", "department", "currency",
        c("exchangeRate").alias("exchange_rate"), "total", c("tranDate").alias("tran_date"),
        c("dueDate").alias("due_date"), "posting", "voided", "memo", c("dateCreated").alias("date_created"),
        c("lastModifiedDate").alias("last_modified_date"),
    )


def pull_transaction_lines(lines: DataFrame, transaction: DataFrame, min_date=DEFAULT_MIN_DATE) -> DataFrame:  # S10
    """Lines whose parent transaction is in the date window.

    Transaction ids are unique, so the inner join that only keeps line
    columns is a semi-join: no parent column is carried through the shuffle.
    """
    parents = transaction.filter(F.col("tranDate") >= F.lit(min_date)).select(F.col("id").alias("_tid"))
    return lines.join(parents, lines["transaction"] == parents["_tid"], "left_semi").select(
        "transaction", "lineSequenceNumber", "account", "amount", "debit", "credit", "department", "class",
        "location", "memo",
    )


def pull_accounts(account: DataFrame) -> DataFrame:  # S11
    c = F.col
    return account.select("id", c("acctName").alias("acct_name"), c("acctNumber").alias("acct_number"),
                          c("acctType").alias("acct_type"), c("generalRateType").alias("general_rate_type"),
                          "parent", c("isInactive").alias("is_inactive"))


def pull_entities(entity: DataFrame) -> DataFrame:  # S11 vendors / customers
    c = F.col
    return entity.select("id", c("entityId").alias("entity_id"), c("companyName").alias("company_name"), "email",
                         "phone", c("isInactive").alias("is_inactive"), c("dateCreated").alias("date_created"))


def pull_subsidiaries(sub: DataFrame) -> DataFrame:  # S11
    return sub.select("id", "name", "country", "currency", F.col("isInactive").alias("is_inactive"))


def pull_departments(dep: DataFrame) -> DataFrame:  # S11
    return dep.select("id", "name", "parent", F.col("isInactive").alias("is_inactive"))


# ---------------------------------------------------------------------------
# System-side tables derived from the driver tables
# ---------------------------------------------------------------------------
def _s(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def system_transactions(lineitem: DataFrame) -> DataFrame:
    d = F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS)
    lid = netsuite_line_id()
    amt = F.col("l_extendedprice").cast(MONEY)
    return lineitem.select(
        lid.alias("id"), F.concat(F.lit("NS-"), lid).alias("tranId"),
        F.when(F.col("l_returnflag") == "R", "Journal").otherwise("CustInvc").alias("type"),
        F.col("l_linestatus").alias("status"), F.concat(F.lit("NS-"), _s("l_partkey")).alias("entity"),
        F.lit("1").alias("subsidiary"), _s(F.col("l_suppkey") % 5).alias("department"), F.lit("1").alias("currency"),
        (F.lit(1) + F.col("l_tax")).cast(RATE).alias("exchangeRate"), amt.alias("total"),
        d.alias("tranDate"), F.date_add(d, 30).alias("dueDate"), (F.col("l_linenumber") != 2).alias("posting"),
        F.lit(False).alias("voided"), F.concat(F.lit("line "), _s("l_linenumber")).alias("memo"),
        F.to_timestamp(d).alias("dateCreated"), F.to_timestamp(d).alias("lastModifiedDate"),
    )


def system_transaction_lines(lineitem: DataFrame) -> DataFrame:
    """Two lines per transaction (debit, credit); entries of orders whose key
    is a multiple of 97 are off by one unit on the credit side."""
    lid = netsuite_line_id()
    amt = F.col("l_extendedprice").cast(MONEY)
    credit = F.when(F.col("l_orderkey") % 97 == 0, (amt - 1).cast(MONEY)).otherwise(amt)
    seq = F.explode(F.array(F.lit(1), F.lit(2))).alias("lineSequenceNumber")
    base = lineitem.select(lid.alias("transaction"), amt.alias("_amt"), credit.alias("_cr"), seq,
                           _s(F.col("l_suppkey") % 5).alias("department"), _s("l_partkey").alias("_acct"))
    is_debit = F.col("lineSequenceNumber") == 1
    return base.select(
        "transaction", "lineSequenceNumber",
        F.when(is_debit, F.lit("1100")).otherwise(F.lit("4000")).alias("account"),
        F.when(is_debit, F.col("_amt")).otherwise(-F.col("_cr")).cast(MONEY).alias("amount"),
        F.when(is_debit, F.col("_amt")).cast(MONEY).alias("debit"),
        F.when(~is_debit, F.col("_cr")).cast(MONEY).alias("credit"),
        "department", F.lit(None).cast("string").alias("class"), F.lit(None).cast("string").alias("location"),
        F.concat(F.lit("item "), F.col("_acct")).alias("memo"),
    )


def system_customers(customer: DataFrame) -> DataFrame:
    k = _s("c_custkey")
    return customer.select(
        F.concat(F.lit("NS-"), k).alias("id"), F.concat(F.lit("CUST"), k).alias("entityId"),
        F.col("c_name").alias("companyName"), F.concat(F.lit("c"), k, F.lit("@ex.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"), (F.col("c_acctbal") < 0).alias("isInactive"),
        F.timestamp_seconds(F.lit(1483228800) + (F.col("c_custkey") % 10000) * 3600).alias("dateCreated"),
    )


def system_vendors(supplier: DataFrame) -> DataFrame:
    k = _s("s_suppkey")
    return supplier.select(
        F.concat(F.lit("VEND-"), k).alias("id"), F.concat(F.lit("VEND"), k).alias("entityId"),
        F.col("s_name").alias("companyName"), F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"), (F.col("s_acctbal") < 0).alias("isInactive"),
        F.timestamp_seconds(F.lit(1483228800) + (F.col("s_suppkey") % 10000) * 3600).alias("dateCreated"),
    )


def system_accounts(supplier: DataFrame) -> DataFrame:
    raw = netsuite_accounts(supplier)
    return raw.select("id", F.col("acct_name").alias("acctName"), F.col("acct_number").alias("acctNumber"),
                      F.col("acct_type").alias("acctType"), F.col("general_rate_type").alias("generalRateType"),
                      "parent", F.col("is_inactive").alias("isInactive"))


def system_subsidiaries(nation: DataFrame) -> DataFrame:
    return nation.select(_s("n_nationkey").alias("id"), F.col("n_name").alias("name"),
                         F.concat(F.lit("R"), _s("n_regionkey")).alias("country"), F.lit("USD").alias("currency"),
                         F.lit(False).alias("isInactive"))


def system_departments(region: DataFrame) -> DataFrame:
    return region.select(_s("r_regionkey").alias("id"), F.col("r_name").alias("name"),
                         F.lit(None).cast("string").alias("parent"), F.lit(False).alias("isInactive"))
