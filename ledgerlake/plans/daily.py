"""One daily run: build every model in dependency order into a warehouse folder.

Layouts follow the reference's model configuration:

| model                    | sink                                   | layout                                         |
| ------------------------ | -------------------------------------- | ---------------------------------------------- |
| golden_customers         | table (S15)                            | day partitions of updated_at (S20)             |
| unified_transactions     | incremental upsert on the unified id   | month of transaction_date, clustered by        |
|                          | (S16, per-source watermarks F11)       | source_system, transaction_type (S19, S21)     |
| chart_of_accounts        | table                                  | --                                             |
| fct_transactions         | incremental upsert on transaction_key  | month of transaction_date, clustered by        |
|                          | (rows with _unified_at > watermark)    | transaction_category, source_system            |
| fct_revenue / cash_flow  | table                                  | month of revenue_date / cash_flow_date         |
| other marts and DQ       | table                                  | --                                             |
| hubs, links, satellites  | insert-only append (J8, J9); what the  | bucketed and sorted on the hash key(s)         |
|                          | spine feeds, by watermark              |                                                |
| snap_dim_customers       | SCD2 (S22)                             | open zone replaced, closed zone only added to  |

Watermarks are noted while a table is written, so no run reads a target for
them. The anti-joins of the vault shuffle the batch alone.

Staging models are temp views (S14). Every step reads the previous steps'
*tables*, not their plans, so lineage stays short and a failed run resumes
from what is already written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import sinks
from ledgerlake.functions import lit_ts
from ledgerlake.params import DEFAULT, RunParams
from ledgerlake.plans import intermediate, marts, quality
from ledgerlake.plans import vault_models as vm
from ledgerlake.plans.staging import Staging
from ledgerlake.sinks.bucketed import BUCKETS, BucketedTable
from ledgerlake.sources import seeds
from ledgerlake.sources.landing import SOURCES

STAGED = ["qb_accounts", "qb_customers", "qb_invoices", "qb_payments", "stripe_charges", "stripe_customers",
          "stripe_balance_transactions", "ns_transactions", "ns_accounts", "plaid_transactions", "plaid_balances",
          "sf_accounts", "sf_opportunities"]


#: bucket columns of each insert-only table: the columns its anti-join compares
VAULT_KEYS = {
    "hub_customer": ["hub_customer_hk"], "hub_account": ["hub_account_hk"], "hub_transaction": ["hub_transaction_hk"],
    "lnk_customer_account": ["lnk_customer_account_hk"], "lnk_transaction_account": ["lnk_transaction_account_hk"],
    "sat_customer_details": ["hub_customer_hk", "hash_diff"], "sat_customer_stripe": ["hub_customer_hk", "hash_diff"],
    "sat_account_balance": ["hub_account_hk", "hash_diff"], "sat_transaction_details": ["hub_transaction_hk", "hash_diff"],
}


def load_vault(spark: SparkSession, path: str, name: str, build, buckets: int = BUCKETS) -> str:
    """Append the rows of vault table ``name`` that ``build(target)`` finds new; 'append' or 'noop'.

    The new rows are cut from their lineage first: they are read once to see
    whether there are any and once to be written, and the table they were
    compared with changes in between."""
    table = BucketedTable(spark, path, VAULT_KEYS[name], buckets)
    new = build(table.read()).checkpoint(eager=True)
    if table.exists() and new.isEmpty():
        return "noop"
    table.append(new)
    return "append"


def run_daily(spark: SparkSession, raw, warehouse: str, p: RunParams = DEFAULT, buckets: int = BUCKETS) -> dict[str, str]:
    """Build all models for ``p`` into ``warehouse``; returns {model: action}."""
    done: dict[str, str] = {}
    t = lambda name: f"{warehouse}/{name}"
    read = lambda name: sinks.read_table(spark, t(name))
    stg = Staging(raw, p)
    for name in STAGED:  # S14
        sinks.view(getattr(stg, name)(), f"stg_{name}")

    # intermediate -----------------------------------------------------------
    golden = intermediate.golden_customers(stg.stripe_customers(), stg.qb_customers(), stg.sf_accounts(), p)
    sinks.write_table(golden, t("golden_customers"), partition_by=("updated_at", "day"))
    done["golden_customers"] = "table"

    utx_path = t("unified_transactions")
    wm = sinks.watermark(spark, utx_path, "_loaded_at", by=True)
    # the ids follow from other columns: they are made once the rows are dealt; _unified_at is noted, so it comes along
    batch = intermediate.spine_rows(stg, p, watermarks=wm).withColumn("_unified_at", lit_ts(p.run_ts))
    done["unified_transactions"] = sinks.upsert(
        batch, utx_path, "transaction_unified_id", partition_by=("transaction_date", "month"),
        cluster_by=["source_system", "transaction_type"],
        watermarks=[("_loaded_at", "source_system", list(SOURCES)), ("_unified_at", None, None)],
        finish=lambda df: intermediate.with_ids(df, p))

    coa = intermediate.unified_chart_of_accounts(stg.qb_accounts(), stg.ns_accounts(), seeds.chart_of_accounts(spark), p)
    sinks.write_table(coa, t("chart_of_accounts"))
    done["chart_of_accounts"] = "table"

    golden, utx_by_month = read("golden_customers").drop("updated_at_day"), read("unified_transactions")
    utx = utx_by_month.drop("transaction_date_month")

    # marts ------------------------------------------------------------------
    fct_path = t("fct_transactions")
    hwm = sinks.watermark(spark, fct_path, "_unified_at")
    new_rows = utx if hwm is None else utx.filter(F.col("_unified_at") > F.lit(hwm))
    done["fct_transactions"] = sinks.upsert(
        marts.fct_transactions(new_rows, golden), fct_path, "transaction_key",
        partition_by=("transaction_date", "month"), cluster_by=["transaction_category", "source_system"],
        watermarks=[("_unified_at", None, None)])
    fct = read("fct_transactions").drop("transaction_date_month")

    builds: dict[str, tuple[DataFrame, tuple[str, str] | None]] = {
        "fct_revenue": (marts.fct_revenue(fct, stg.sf_opportunities(), golden, p), ("revenue_date", "month")),
        "fct_cash_flow": (marts.fct_cash_flow(stg.plaid_transactions(), stg.stripe_balance_transactions(),
                                              stg.plaid_balances(), p), ("cash_flow_date", "month")),
        "fct_accounts_receivable": (marts.fct_accounts_receivable(stg.qb_invoices(), golden, p), None),
        "dim_customers": (marts.dim_customers(golden, fct, p), None),
        "dim_accounts": (marts.dim_accounts(read("chart_of_accounts")), None),
        "dim_date": (marts.dim_date(spark, p), None),
    }
    for name, (df, part) in builds.items():
        sinks.write_table(df, t(name), partition_by=part)
        done[name] = "table"
    dim = read("dim_customers")

    # data quality -----------------------------------------------------------
    for name, df in {
        "dq_cross_source_reconciliation": quality.cross_source_reconciliation(utx_by_month, p),
        "dq_golden_record_completeness": quality.golden_record_completeness(dim, p),
        "dq_source_freshness": quality.source_freshness(utx_by_month, p),
        "dq_transaction_anomalies": quality.transaction_anomalies(utx_by_month, p),
    }.items():
        sinks.write_table(df, t(name))
        done[name] = "table"

    # vault: insert-only -------------------------------------------------------
    def vault(name, build):
        done[name] = load_vault(spark, t(name), name, build, buckets)

    spine_mark = sinks.watermark(spark, utx_path, "_unified_at")

    def from_spine(name, build):
        # rows stamped since the last load of this table that ended; the note follows the append, so a
        # load that was cut off is fed again and adds what is missing
        fed = sinks.watermark(spark, t(name), "_unified_at")
        rows = utx if fed is None else utx.filter(F.col("_unified_at") > F.lit(fed))
        vault(name, lambda cur: build(rows, cur))
        sinks.note_watermark(spark, t(name), "_unified_at", spine_mark)

    vault("hub_customer", lambda cur: vm.hub_customer(stg.qb_customers(), stg.stripe_customers(), stg.sf_accounts(), cur))
    vault("hub_account", lambda cur: vm.hub_account(stg.qb_accounts(), stg.ns_accounts(), cur))
    from_spine("hub_transaction", vm.hub_transaction)
    vault("lnk_customer_account", lambda cur: vm.lnk_customer_account(stg.qb_invoices(), cur))
    from_spine("lnk_transaction_account", vm.lnk_transaction_account)
    vault("sat_customer_details", lambda cur: vm.sat_customer_details(stg.qb_customers(), cur))
    vault("sat_customer_stripe", lambda cur: vm.sat_customer_stripe(stg.stripe_customers(), cur))
    vault("sat_account_balance", lambda cur: vm.sat_account_balance(stg.qb_accounts(), cur))
    from_spine("sat_transaction_details", vm.sat_transaction_details)

    # snapshot ------------------------------------------------------------------
    sinks.write_snapshot(dim, t("snap_dim_customers"), "customer_key", "_dim_updated_at", p.run_ts)
    done["snap_dim_customers"] = "scd2"
    return done
