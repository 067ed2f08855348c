"""Registered queries that write tables as a run does and read them back.

Each makes its tables in a new folder below the session's checkpoint folder,
takes them through the runs that its docstring names, and returns what a
reader finds there. The oracle states the same outcome in one SELECT.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.operators.ordering import ranked
from ledgerlake.plans import intermediate
from ledgerlake.plans import vault_models as vm
from ledgerlake.plans.daily import load_vault
from ledgerlake.plans.model import Model
from ledgerlake.session import shared_folder
from ledgerlake.sinks.publish import Files
from ledgerlake.sources import landing
from ledgerlake.sources.raw_schemas import RAW_SCHEMAS
from oracle.duck import sk

CUTOFF = "2024-01-20 06:00:00"
RUN1 = dt.datetime(2024, 1, 30, 6)
SPINE_MONTH = ("transaction_date", "month")


def _folder(m: Model, name: str) -> str:
    return f"{shared_folder(m.spark)}/{name}-{uuid.uuid4().hex}"


def _by(col: str, cutoff: str = CUTOFF):
    return F.col(col) <= F.lit(cutoff).cast("timestamp")


def _date(text: str):
    return F.lit(text).cast("date")


def _months(sql: str) -> str:
    return f"SELECT *, strftime(transaction_date, '%Y-%m') AS transaction_date_month FROM ({sql}) t"


# Merges ------------------------------------------------------

#: the second run's spine: a month whose rows all move on, undated rows that get their date, dated rows that lose it
_MOVED = """SELECT * REPLACE (CASE WHEN strftime(transaction_date, '%Y-%m') = '2019-03' THEN transaction_date + 40
  WHEN source_system = 'quickbooks' AND strftime(transaction_date, '%Y-%m') = '2020-05' THEN NULL
  WHEN source_system = 'netsuite' AND strftime(transaction_date, '%Y-%m') = '2018-06' THEN NULL
  ELSE transaction_date END AS transaction_date) FROM unified_transactions"""


def upsert_moved_and_null_dates(m: Model) -> DataFrame:
    """S16 + S17 + S19: the spine merged three times on its id. Run 1 makes
    the table, with NetSuite's and QuickBooks' rows of 2018-06 undated and
    those after the cut-off absent. Run 2 dates the QuickBooks ones, adds the
    late ones and moves every row of 2019-03 on, which empties that month. Run 3 takes the
    date of QuickBooks' rows of 2020-05 away."""
    path, key = _folder(m, "s16"), "transaction_unified_id"
    month, src, day = F.date_format("transaction_date", "yyyy-MM"), F.col("source_system"), F.col("transaction_date")
    undated = month.eqNullSafe("2018-06") & src.isin("netsuite", "quickbooks")
    # the spine's rows without the columns that follow from others: those are made once the rows are dealt
    spine = m.spine_rows
    first = spine.filter(_by("_loaded_at")).withColumn("transaction_date", F.when(~undated, day))
    late = spine.filter(~_by("_loaded_at") | (undated & (src == "quickbooks")) | (month == "2019-03"))
    second = late.withColumn("transaction_date", F.when(month == "2019-03", F.date_add(day, 40)).when(~(undated & (src == "netsuite")), day))
    third = spine.filter((src == "quickbooks") & (month == "2020-05")).withColumn("transaction_date", F.lit(None).cast("date"))
    for batch in (first, second, third):
        sinks.upsert(batch, path, key, SPINE_MONTH, ["source_system", "transaction_type"], finish=m._with_ids)
    return sinks.read_table(m.spark, path)


def upsert_day_partitions(m: Model) -> DataFrame:
    """S16 + S20: bank transactions by day, merged on their id. Run 1 makes the
    table with all inflows undated, run 2 dates those of one account in ten,
    run 3 moves the outflows of 2024-01-05 a day on."""
    path, day, key = _folder(m, "s20"), F.col("transaction_date"), "plaid_transaction_id"
    tx = m.stg.plaid_transactions().select(key, "plaid_account_id", "amount", "flow_direction", "transaction_date")
    inflow, own = F.col("flow_direction") == "inflow", F.col("plaid_account_id").endswith("7")
    sinks.upsert(tx.withColumn("transaction_date", F.when(~inflow, day)), path, key, ("transaction_date", "day"))
    sinks.upsert(tx.filter(inflow & own), path, key, ("transaction_date", "day"))
    sinks.upsert(tx.filter(~inflow & (day == _date("2024-01-05"))).withColumn("transaction_date", F.date_add(day, 1)), path, key, ("transaction_date", "day"))
    return sinks.read_table(m.spark, path)


def partition_row_counts(m: Model) -> DataFrame:
    """What a reader of single months finds after the merges of ``s16_upsert_moved_and_null_dates``:
    rows and totals per month folder, an emptied month absent."""
    t = upsert_moved_and_null_dates(m)
    return t.groupBy("transaction_date_month").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(28,9)").alias("total"))


# Rebuilds ---------------------------------------------------

def rebuild_day_partitions(m: Model) -> DataFrame:
    """S15 + S20: golden customers by day of first_seen_at, built whole, then
    rebuilt without the delinquent ones: nothing of the first build is left."""
    path = _folder(m, "s15")
    sinks.write_table(m.golden, path, ("first_seen_at", "day"))
    sinks.write_table(m.golden.filter(~F.coalesce("is_delinquent", F.lit(False))), path, ("first_seen_at", "day"))
    return sinks.read_table(m.spark, path)


def replace_without_partitions(m: Model) -> DataFrame:
    """S3 + S14: the chart of accounts replaced as one table, read through a view."""
    path = _folder(m, "s3")
    sinks.write_table(m.chart_of_accounts.filter("source_system = 'netsuite'"), path)
    sinks.write_table(m.chart_of_accounts, path)
    sinks.view(sinks.read_table(m.spark, path), "chart_of_accounts_s3")
    return m.spark.table("chart_of_accounts_s3")


def clustered_ranges(m: Model) -> DataFrame:
    """The spine by month, clustered by (source_system, transaction_type).
    Per month: rows, and how many files hold keys below the greatest of the
    file before them (0: a reader of one cluster skips the other files)."""
    path = _folder(m, "s21")
    sinks.write_table(m.utx, path, SPINE_MONTH, ["source_system", "transaction_type"])
    key = F.struct("source_system", "transaction_type")
    t = sinks.read_table(m.spark, path).withColumn("file", F.col("_metadata.file_path"))
    files = t.groupBy("transaction_date_month", "file").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n"))
    from pyspark.sql import Window
    before = F.max("high").over(Window.partitionBy("transaction_date_month").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    files = files.withColumn("overlaps", F.coalesce(F.col("low") < before, F.lit(False)))
    return files.groupBy("transaction_date_month").agg(F.sum("n").alias("n"), F.count_if("overlaps").alias("overlapping_files"))


# Schemas ---------------------------------------------------------------

def schema_evolution(m: Model) -> DataFrame:
    """Invoices by month with whole currency units as int; the second
    batch has them as decimal(18,4), adds the invoice number and lacks the email status."""
    path = _folder(m, "s18")
    inv = m.stg.qb_invoices()
    first = inv.select("invoice_id", "invoice_date", F.floor("total_amount").cast("int").alias("total"), "email_status")
    sinks.upsert(first, path, "invoice_id", ("invoice_date", "month"))
    late = inv.filter(~_by("_loaded_at")).select("invoice_id", "invoice_date", F.col("total_amount").cast("decimal(18,4)").alias("total"), "invoice_number")
    sinks.upsert(late, path, "invoice_id", ("invoice_date", "month"))
    return sinks.read_table(m.spark, path)


# Watermarks -----------------------------------------------------

def noted_watermarks(m: Model) -> DataFrame:
    """F11 + A7 + S17: the spine in two incremental runs. The second takes its
    per-source bounds from the marks noted while the first was written, and
    nothing is read for them. Result: the marks noted after both, per source."""
    path = _folder(m, "f11")
    marks = [("_loaded_at", "source_system", list(landing.SOURCES))]
    first = intermediate.spine_rows(m.stg, m.p).filter(_by("_loaded_at"))
    sinks.upsert(first, path, "transaction_unified_id", SPINE_MONTH, watermarks=marks, finish=m._with_ids)
    noted = sinks.watermark(m.spark, path, "_loaded_at", by=True)
    second = intermediate.spine_rows(m.stg, m.p, watermarks=noted)
    sinks.upsert(second, path, "transaction_unified_id", SPINE_MONTH, watermarks=marks, finish=m._with_ids)
    noted = sinks.watermark(m.spark, path, "_loaded_at", by=True)
    table = sinks.read_table(m.spark, path).groupBy("source_system").agg(F.count("*").alias("n"))
    mark = F.create_map(*[F.lit(x) for s, w in noted.items() for x in (s, w)])
    return table.select("source_system", "n", F.element_at(mark, F.col("source_system")).alias("watermark"))


# Insert-only tables ------------------------------------------------------

def hub_second_run(m: Model) -> DataFrame:
    """hub_customer as a bucketed table loaded in three runs (early rows, all rows, all again): no key twice."""
    path = _folder(m, "j8")
    frames = [m.stg.qb_customers(), m.stg.stripe_customers(), m.stg.sf_accounts()]
    for rows in ([f.filter(_by("_loaded_at", "2024-01-29 06:00:00")) for f in frames], frames, frames):
        load_vault(m.spark, path, "hub_customer", lambda cur, rows=rows: vm.hub_customer(*rows, cur))
    return sinks.BucketedTable(m.spark, path, ["hub_customer_hk"]).read()


def _repriced(df: DataFrame) -> DataFrame:
    """Customers whose id ends in 3 with another balance, loaded at the run's time; the others as they were."""
    hit = F.col("customer_id").endswith("3")
    balance = (F.col("outstanding_balance") + 1).cast(df.schema["outstanding_balance"].dataType)
    return df.withColumn("outstanding_balance", F.when(hit, balance).otherwise(F.col("outstanding_balance"))).withColumn(
        "_loaded_at", F.when(hit, F.lit("2024-01-31 06:00:00").cast("timestamp")).otherwise(F.col("_loaded_at")))


def satellite_changed_hash(m: Model) -> DataFrame:
    """sat_customer_details as a bucketed table: run 1 all customers, run 2
    with one in ten changed (a second version each), run 3 the same again (nothing)."""
    path, qb = _folder(m, "j9"), m.stg.qb_customers()
    early = qb.withColumn("_loaded_at", F.lit("2024-01-10 06:00:00").cast("timestamp"))
    for rows in (early, _repriced(early), _repriced(early)):
        load_vault(m.spark, path, "sat_customer_details", lambda cur, rows=rows: vm.sat_customer_details(rows, cur))
    return sinks.BucketedTable(m.spark, path, ["hub_customer_hk", "hash_diff"]).read().select(
        "hub_customer_hk", "display_name", "outstanding_balance", "load_date", "record_source")


# Snapshot -------------------------------------------------------------

_KEPT, _LATE, _CHANGED = "substr(customer_key, 1, 1) <> 'f'", "substr(customer_key, 1, 1) <> '0'", "substr(customer_key, 1, 1) < '8'"


def snapshot_zones(m: Model) -> DataFrame:
    """S22 + M37: the customer dimension snapshot in three runs, by the first
    digit of the key: 0 is new in run 2, 1 to 7 changed in it, 8 to e did not,
    f is deleted in it. Run 3 repeats run 2."""
    path = _folder(m, "m37")
    early = m.dim_customers.withColumn("_dim_updated_at", F.lit(RUN1).cast("timestamp"))
    late = m.dim_customers.filter(_KEPT)
    late = late.withColumn("_dim_updated_at", F.when(F.expr(_CHANGED), F.lit(m.p.run_ts).cast("timestamp")).otherwise(F.lit(RUN1).cast("timestamp")))
    for current, at in ((early.filter(_LATE), RUN1), (late, m.p.run_ts), (late, m.p.run_ts)):
        sinks.write_snapshot(current, path, "customer_key", "_dim_updated_at", at)
    return sinks.read_snapshot(m.spark, path).select(
        "customer_key", "company_name", "lifetime_revenue", "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


_R1, _R2 = "2024-01-30 06:00:00", "2024-01-31 06:00:00"
_SNAPSHOT = f"""
WITH v AS (
  SELECT *, TIMESTAMP '{_R1}' AS f, CASE WHEN {_CHANGED} OR NOT {_KEPT} THEN TIMESTAMP '{_R2}' END AS t FROM dim_customers WHERE {_LATE}
  UNION ALL SELECT *, TIMESTAMP '{_R2}', NULL FROM dim_customers WHERE {_CHANGED})
SELECT customer_key, company_name, lifetime_revenue, md5(customer_key || '|' || strftime(f, '%Y-%m-%d %H:%M:%S')) AS dbt_scd_id,
  f AS dbt_updated_at, f AS dbt_valid_from, t AS dbt_valid_to FROM v"""


# Landing -------------------------------------------------

_PLAID = RAW_SCHEMAS["plaid.transactions"].split(", _loaded_at")[0]
_SPLIT, _LAND = "2024-01-15", [dt.datetime(2024, 1, 15, 6), dt.datetime(2024, 1, 31, 6), dt.datetime(2024, 2, 1, 6)]


def _extracts(m: Model, folder: str) -> list[str]:
    """Extract files of three batches, a folder per linked account: the rows up to _SPLIT, the later ones, none. Of every
    transaction on the 1st of a month the line stands there once more, cut off after 30 characters."""
    tx = m.raw("plaid.transactions").drop("_loaded_at", "_source_system")
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in tx.columns]))
    first = F.dayofmonth("date") == 1
    lines = tx.select("date", F.col("account_id").alias("account"), F.explode(F.array_compact(F.array(line, F.when(first, F.substring(line, 1, 30))))).alias("value"))
    paths = []
    for i, which in enumerate([F.col("date") <= _date(_SPLIT), F.col("date") > _date(_SPLIT), F.lit(False)]):
        lines.filter(which).drop("date").write.partitionBy("account").text(f"{folder}/extract{i}")
        paths.append(f"{folder}/extract{i}")
    return paths


def _landed(m: Model) -> tuple[str, list[dict]]:
    folder = _folder(m, "s1")
    target, files = f"{folder}/raw_plaid/transactions", Files(m.spark, folder)
    did = []
    for batch, at in zip(_extracts(m, folder), _LAND):
        accounts = [f"{batch}/{a}" for a in files.folders(batch)] or [batch]
        did.append(landing.land_files(m.spark, accounts, _PLAID, target, at, "plaid"))
        if at == _LAND[1]:  # the same batch once more takes the place of its first try
            landing.land_files(m.spark, accounts, _PLAID, target, at, "plaid")
    return target, did


def landed_accounts(m: Model) -> DataFrame:
    """S1 + S2 + S4 + S7: all accounts' extract files of three batches landed (the second twice, the third empty), as the raw table is read."""
    target, _ = _landed(m)
    return landing.read_landed(m.spark, target, _PLAID).drop(landing.SOURCE_FILE)


def landed_batches(m: Model) -> DataFrame:
    """S4 + S5: per batch the records landed, lines quarantined and accounts they came from; the empty batch left no trace."""
    target, _ = _landed(m)
    account = F.regexp_extract(landing.SOURCE_FILE, "account=([^/]+)/", 1).alias("account")
    good = landing.read_landed(m.spark, target, _PLAID).select("_loaded_at", account, F.lit(1).alias("landed"), F.lit(0).alias("quarantined"))
    bad = landing.read_quarantine(m.spark, target).select("_loaded_at", account, F.lit(0).alias("landed"), F.lit(1).alias("quarantined"))
    return good.unionByName(bad).groupBy("_loaded_at").agg(
        F.sum("landed").alias("landed"), F.sum("quarantined").alias("quarantined"), F.count_distinct("account").alias("accounts"))


def registry_json(m: Model) -> DataFrame:
    """The declared source table stripe.charges, landed as JSON and read by its name."""
    root = _folder(m, "s12")
    charges = m.raw("stripe.charges")
    charges.withColumn("_loaded_at", F.date_format(F.col("_loaded_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")).write.json(f"{root}/raw_stripe/charges")
    registry = landing.SourceRegistry(m.spark, root, "json")
    return registry("stripe.charges").select("id", "amount", "created", "metadata", F.col("_loaded_at").cast("timestamp").alias("_loaded_at"))


# O1-O3: order -----------------------------------------------------------------

def reconciliation_ranked(m: Model) -> DataFrame:
    """O1: the reconciliation by date and absolute variance, both descending, then category, with the row's place."""
    return ranked(m.dq_reconciliation, [F.col("transaction_date").desc(), F.col("absolute_variance").desc(), F.col("transaction_category")])


def completeness_ranked(m: Model) -> DataFrame:
    """O2: customers by completeness, then key, with the row's place."""
    return ranked(m.dq_completeness, [F.col("completeness_pct").asc(), F.col("customer_key")]).select("customer_key", "completeness_pct", "rank")


def freshness_ranked(m: Model) -> DataFrame:
    """O3: sources by severity (critical, warning, healthy), then name, with the row's place."""
    severity = F.when(F.col("freshness_status") == "critical", 1).when(F.col("freshness_status") == "warning", 2).otherwise(3)
    return ranked(m.dq_freshness, [severity, F.col("source_system")]).select("source_system", "freshness_status", "rank")


def add(register) -> None:
    register("s16_upsert_moved_and_null_dates", _months(_MOVED))(upsert_moved_and_null_dates)
    register("s19_month_partitions_after_merges", f"""SELECT transaction_date_month, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,9)) AS total
FROM ({_months(_MOVED)}) u GROUP BY 1""")(partition_row_counts)
    register("s20_upsert_day_partitions", """SELECT *, transaction_date AS transaction_date_day FROM (
  SELECT plaid_transaction_id, plaid_account_id, amount, flow_direction,
    CASE WHEN flow_direction = 'inflow' AND right(plaid_account_id, 1) <> '7' THEN NULL
      WHEN flow_direction <> 'inflow' AND transaction_date = DATE '2024-01-05' THEN transaction_date + 1 ELSE transaction_date END AS transaction_date
  FROM stg_plaid_transactions) t""")(upsert_day_partitions)
    register("s15_rebuild_day_partitions", """SELECT *, CAST(first_seen_at AS DATE) AS first_seen_at_day FROM golden_customers
WHERE NOT coalesce(is_delinquent, false)""")(rebuild_day_partitions)
    register("s3_s14_replace_and_view", "SELECT * FROM chart_of_accounts")(replace_without_partitions)
    register("s21_clustered_month_files", """SELECT strftime(transaction_date, '%Y-%m') AS transaction_date_month, count(*) AS n,
  0 AS overlapping_files FROM unified_transactions GROUP BY 1""")(clustered_ranges)
    register("s18_schema_evolution", f"""SELECT invoice_id, invoice_date,
  CAST(CASE WHEN _loaded_at > TIMESTAMP '{CUTOFF}' THEN total_amount ELSE floor(total_amount) END AS DECIMAL(18,4)) AS total,
  CASE WHEN _loaded_at > TIMESTAMP '{CUTOFF}' THEN NULL ELSE email_status END AS email_status,
  CASE WHEN _loaded_at > TIMESTAMP '{CUTOFF}' THEN invoice_number END AS invoice_number,
  strftime(invoice_date, '%Y-%m') AS invoice_date_month FROM stg_qb_invoices""")(schema_evolution)
    register("f11_a7_noted_watermarks", """SELECT source_system, count(*) AS n, max(_loaded_at) AS watermark
FROM unified_transactions GROUP BY 1""")(noted_watermarks)
    key = sk("bk", "record_source")
    register("j8_hub_bucketed_runs", f"""SELECT {key} AS hub_customer_hk, bk AS customer_bk, record_source, min(load_date) AS load_date FROM (
  SELECT customer_id AS bk, 'quickbooks' AS record_source, _loaded_at AS load_date FROM stg_qb_customers
  UNION ALL SELECT stripe_customer_id, 'stripe', _loaded_at FROM stg_stripe_customers
  UNION ALL SELECT sf_account_id, 'salesforce', _loaded_at FROM stg_sf_accounts) s GROUP BY ALL""")(hub_second_run)
    hub = sk("customer_id", "'quickbooks'")
    register("j9_satellite_changed_hash", f"""SELECT {hub} AS hub_customer_hk, display_name, outstanding_balance,
  TIMESTAMP '2024-01-10 06:00:00' AS load_date, 'quickbooks' AS record_source FROM stg_qb_customers
UNION ALL SELECT {hub}, display_name, outstanding_balance + 1, TIMESTAMP '2024-01-31 06:00:00', 'quickbooks' FROM stg_qb_customers
  WHERE right(customer_id, 1) = '3' AND outstanding_balance IS NOT NULL""")(satellite_changed_hash)
    register("m37_snapshot_zones", _SNAPSHOT)(snapshot_zones)
    late = f"CASE WHEN date <= DATE '{_SPLIT}' THEN TIMESTAMP '{_LAND[0]}' ELSE TIMESTAMP '{_LAND[1]}' END"
    register("s1_s7_landed_accounts", f"""SELECT * EXCLUDE (_loaded_at), {late} AS _loaded_at, 'plaid' AS _source_system FROM raw_plaid_transactions""")(landed_accounts)
    register("s4_s5_landed_batches", f"""SELECT {late} AS _loaded_at, count(*) AS landed, count_if(day(date) = 1) AS quarantined,
  count(DISTINCT account_id) AS accounts FROM raw_plaid_transactions GROUP BY 1""")(landed_batches)
    register("s12_registry_json", "SELECT id, amount, created, metadata, _loaded_at FROM raw_stripe_charges")(registry_json)
    register("o1_reconciliation_ranked", """SELECT *, row_number() OVER (ORDER BY transaction_date DESC, absolute_variance DESC, transaction_category) AS rank
FROM reconciliation_all WHERE reconciliation_status <> 'match'""")(reconciliation_ranked)
    register("o2_completeness_ranked", """SELECT customer_key, completeness_pct, row_number() OVER (ORDER BY completeness_pct, customer_key) AS rank
FROM golden_record_completeness""")(completeness_ranked)
    register("o3_freshness_ranked", """SELECT source_system, freshness_status, row_number() OVER (ORDER BY
  CASE freshness_status WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END, source_system) AS rank FROM source_freshness""")(freshness_ranked)
