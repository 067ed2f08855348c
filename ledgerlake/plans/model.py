"""Wires the jobs together over one raw-table accessor.

``Model`` is lazy: each property builds a DataFrame plan on first use and
returns the same object afterwards, so a plan that uses a frame twice (e.g.
golden customers in fct_transactions and dim_customers) shares one subtree
and Spark can reuse its exchange. Nothing here triggers an action.
"""

from __future__ import annotations

import copy
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlake import sinks
from ledgerlake.params import DEFAULT, RunParams
from ledgerlake.plans import intermediate, marts, quality
from ledgerlake.plans.staging import Staging
from ledgerlake.sources import seeds
from ledgerlake.sources.driver_tables import DriverRaw
from ledgerlake.session import configure, cut, shared_folder


_MODELS: dict = {}


class Model:
    def __init__(self, spark: SparkSession, raw, params: RunParams = DEFAULT, watermarks: dict | None = None,
                 materialize_tables: bool = True, plans: dict | None = None):
        self.spark, self.raw, self.p = spark, raw, params
        self.plans = plans if plans is not None and watermarks is None else {}
        if "stg" not in self.plans:
            self.plans["stg"] = Staging(raw, params)
        self.stg = self.plans["stg"]
        self.watermarks = watermarks
        self.materialize_tables = materialize_tables

    def _plan(self, name: str, build):
        """Lazy plan shared by every run of this session (analysed once)."""
        if name not in self.plans:
            self.plans[name] = build()
        return self.plans[name]

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT, fresh: bool = False) -> "Model":
        """Model over the driver tables of ``sf_dir``.

        One Model per (session, directory, parameters) is kept, like views
        defined once per session, so the jobs of one run share its tables.
        ``fresh=True`` (or clearing ``_MODELS``) starts a new run: tables are
        built again, from a new listing of the input files.
        """
        configure(spark)  # the jobs are defined in UTC with AQE on, whatever session calls them
        key = (spark.sparkContext.applicationId, sf_dir, params)
        if fresh or key not in _MODELS:
            _MODELS[key] = cls(spark, DriverRaw(spark, sf_dir, params), params)
        return _MODELS[key]

    def materialize(self, *names: str) -> "Model":
        """Cut the lineage of the named frames: write them once to the shared
        ``spark.checkpoint.dir`` (reliable checkpoint), so later jobs that read
        them several times -- e.g. a check suite -- scan the stored rows instead
        of recomputing the whole plan; a lost executor re-reads the checkpoint.
        Returns a copy; ``self`` keeps
        its frames. Frames that are already tables are left as they are.
        """
        clone = copy.copy(self)  # the shared per-session Model keeps its lazy plans
        for n in names:
            df = getattr(clone, n)
            clone.__dict__[n] = cut(df)
        return clone

    def _table(self, df: DataFrame, name: str, partition_by: tuple[str, str] | None = None, finish=None) -> DataFrame:
        """A model the reference materializes as a table and several jobs read:
        written once per run as parquet files in the shared folder, so readers
        get the columns and partitions they need and a lost executor's tasks read the files again."""
        if not self.materialize_tables:
            df = finish(df) if finish else df
            return sinks.partition_column(df, *partition_by)[0] if partition_by else df
        # a new Dataset over the shared (already analysed) plan: fresh physical
        # plan and shuffles, so a new run never reuses an earlier run's output
        df = df.select("*")
        path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
        sinks.write_table(df, path, partition_by, finish=finish)
        return sinks.read_table(self.spark, path)

    # intermediate ---------------------------------------------------------
    @cached_property
    def golden(self) -> DataFrame:
        return self._table(self._plan("golden", lambda: intermediate.golden_customers(
            self.stg.stripe_customers(), self.stg.qb_customers(), self.stg.sf_accounts(), self.p
        )), "golden_customers")

    @property
    def spine_rows(self) -> DataFrame:
        """The spine's plan, its rows without the columns that ``_with_ids`` makes."""
        return self._plan("utx", lambda: intermediate.spine_rows(self.stg, self.p, self.watermarks))

    def _with_ids(self, rows: DataFrame) -> DataFrame:
        return intermediate.with_ids(rows, self.p)

    @cached_property
    def utx_by_month(self) -> DataFrame:
        """The spine as its month-partitioned table (S19), with the month column."""
        return self._table(self.spine_rows, "unified_transactions", ("transaction_date", "month"), self._with_ids)

    @cached_property
    def utx(self) -> DataFrame:
        return self.utx_by_month.drop("transaction_date_month")

    @property
    def spine(self) -> DataFrame:
        """The spine for a job that deals all its rows anew: from the month table
        where a job has made it, else its plan, without a table in between."""
        return self.utx if "utx_by_month" in self.__dict__ else self._with_ids(self.spine_rows)

    @cached_property
    def chart_of_accounts(self) -> DataFrame:
        return intermediate.unified_chart_of_accounts(
            self.stg.qb_accounts(), self.stg.ns_accounts(), seeds.chart_of_accounts(self.spark), self.p
        )

    # marts ----------------------------------------------------------------
    @cached_property
    def fct_transactions(self) -> DataFrame:
        """M26 from the spine's table where a job has made it, else from the spine's plan: the
        month table serves readers of single months, this job reads every row once."""
        if "utx_by_month" in self.__dict__:
            fct = marts.fct_transactions(self.utx, self.golden)
        else:
            fct = marts.fct_transactions(self.spine_rows, self.golden, self._with_ids)
        return self._table(fct, "fct_transactions")

    @cached_property
    def fct_revenue(self) -> DataFrame:
        return marts.fct_revenue(self.fct_transactions, self.stg.sf_opportunities(), self.golden, self.p)

    @cached_property
    def fct_cash_flow(self) -> DataFrame:
        return marts.fct_cash_flow(
            self.stg.plaid_transactions(), self.stg.stripe_balance_transactions(), self.stg.plaid_balances(), self.p
        )

    @cached_property
    def fct_accounts_receivable(self) -> DataFrame:
        return marts.fct_accounts_receivable(self.stg.qb_invoices(), self.golden, self.p)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._table(marts.dim_customers(self.golden, self.fct_transactions, self.p), "dim_customers")

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return marts.dim_accounts(self.chart_of_accounts)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, self.p)

    # data quality ---------------------------------------------------------
    @cached_property
    def dq_reconciliation(self) -> DataFrame:
        return quality.cross_source_reconciliation(self.utx_by_month, self.p)

    @cached_property
    def dq_completeness(self) -> DataFrame:
        return quality.golden_record_completeness(self.dim_customers, self.p)

    @cached_property
    def dq_freshness(self) -> DataFrame:
        return quality.source_freshness(self.utx_by_month, self.p)

    @cached_property
    def dq_anomalies(self) -> DataFrame:
        return quality.transaction_anomalies(self.utx_by_month, self.p)
