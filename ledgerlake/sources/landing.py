"""Landing of extracted records (S1, S2, S4-S8) and the source registry.

Extracts are newline-delimited JSON files that Spark reads in parallel; one
read covers many linked accounts' files (S7). ``land_files`` parses them once
under the declared schema: whole records go to the raw table, lines that are
no such record to its quarantine, each with the file it came from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions import lit_date, lit_ts
from ledgerlake.sinks.publish import Files, publish_folders, recover, staged_path

CORRUPT, SOURCE_FILE, BATCH, QUARANTINE = "_corrupt_record", "_source_file", "_batch", "_quarantine"


def read_landed_json(spark: SparkSession, paths: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """S1 + S7: newline-delimited JSON, explicit schema or inferred."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def land_files(spark: SparkSession, paths: str | list[str], schema: str, target: str, loaded_at, source_system: str) -> dict[str, int]:
    """Add one batch of extract files to the raw table at
    ``target``; returns the numbers of records landed and lines quarantined.

    The batch is one folder of the table (and one of its quarantine), named by
    its load time: a batch that is landed again takes the place of its first
    try, and one that dies half-way leaves nothing. A batch without any line
    changes nothing. Lines are read once; Spark counts them while it writes."""
    recover(spark, target)
    text = spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT).json(paths)
    whole = F.col(CORRUPT).isNull()
    rows = stamp(text.withColumn(SOURCE_FILE, F.col("_metadata.file_path")), loaded_at, source_system)
    seen = Observation()
    rows = rows.withColumn("_whole", whole).observe(seen, F.count_if("_whole").alias("landed"), F.count_if(~F.col("_whole")).alias("quarantined"))
    staged, batch = staged_path(target), f"{BATCH}={loaded_at:%Y%m%dT%H%M%S}"
    rows.write.mode("overwrite").partitionBy("_whole").parquet(f"{staged}/_parsed")
    counts = {k: seen.get.get(k) or 0 for k in ("landed", "quarantined")}
    files = Files(spark, target)
    names = []
    for part, name in (("_whole=true", batch), ("_whole=false", f"{QUARANTINE}/{batch}")):
        if files.exists(f"{staged}/_parsed/{part}"):
            files.move(f"{staged}/_parsed/{part}", f"{staged}/{name}")
            names.append(name)
    if names:
        publish_folders(spark, target, names, [])
    else:
        files.delete(staged)
    return counts


def read_landed(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """The raw table: whole records of all batches, with their stamps and files."""
    recover(spark, target)
    return spark.read.schema(f"{schema}, {SOURCE_FILE} string, _loaded_at timestamp, _source_system string").parquet(target).drop(BATCH)


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """Lines that are no record of the declared schema, as they came."""
    recover(spark, target)
    folder = f"{target.rstrip('/')}/{QUARANTINE}"
    schema = f"{CORRUPT} string, {SOURCE_FILE} string, _loaded_at timestamp, _source_system string"
    if not Files(spark, target).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).drop(BATCH)


def stamp(df: DataFrame, loaded_at, source_system: str) -> DataFrame:
    """One ``_loaded_at`` value per batch plus ``_source_system``."""
    return df.withColumns({"_loaded_at": lit_ts(loaded_at), "_source_system": F.lit(source_system)})


def flatten_balances(df: DataFrame, run_ts) -> DataFrame:
    """Nested ``balances`` struct -> flat columns + snapshot_date (run date, UTC)."""
    b = "balances"
    return df.select(
        "account_id",
        F.col(f"{b}.current").alias("current"),
        F.col(f"{b}.available").alias("available"),
        F.col(f"{b}.limit").alias("limit"),
        F.col(f"{b}.iso_currency_code").alias("iso_currency_code"),
        F.to_date(lit_ts(run_ts)).alias("snapshot_date"),
    )


def lookback(df: DataFrame, date_col: str, run_date, days: int = 30) -> DataFrame:
    """Keep [run_date - days, run_date]; a literal range, so it is pushed to the scan."""
    d = lit_date(run_date)
    return df.filter(F.col(date_col).between(F.date_sub(d, days), d))


# ---------------------------------------------------------------------------
# S12 named source registry
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Source:
    name: str
    tables: tuple[str, ...]
    warn_after_hours: int
    error_after_hours: int
    loaded_at_field: str = "_loaded_at"


# Declared sources, their tables and freshness thresholds (hours)
SOURCES = {
    "quickbooks": Source("quickbooks", ("accounts", "invoices", "invoice_lines", "bills", "payments",
                                        "journal_entries", "customers", "vendors"), 12, 24),
    "stripe": Source("stripe", ("charges", "refunds", "payouts", "customers", "subscriptions", "invoices",
                                "balance_transactions"), 6, 12),
    "netsuite": Source("netsuite", ("transactions", "transaction_lines", "accounts", "vendors", "customers",
                                    "subsidiaries", "departments", "currencies"), 12, 24),
    "plaid": Source("plaid", ("transactions", "accounts", "balances"), 24, 48),
    "salesforce": Source("salesforce", ("opportunities", "opportunity_line_items", "accounts", "contacts",
                                        "contracts"), 12, 24),
}


@dataclass
class SourceRegistry:
    """``registry('stripe.charges')`` -> DataFrame at ``{root}/raw_{source}/{table}``."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        source, table = name.split(".", 1)
        if source not in SOURCES or table not in SOURCES[source].tables:
            raise KeyError(name)
        return f"{self.root}/raw_{source}/{table}"

    def __call__(self, name: str) -> DataFrame:
        r = self.spark.read.format(self.fmt).options(**self.options)
        if self.fmt == "json":  # S1: explicit schema instead of inference
            from ledgerlake.sources.raw_schemas import RAW_SCHEMAS

            r = r.schema(RAW_SCHEMAS[name])
        return r.load(self.path(name))


def loaded_at_by_source(raw, names: list[str]) -> DataFrame:
    """(source, _loaded_at) rows of the given raw tables, for freshness (Q9)."""
    parts = [raw(n).select(F.lit(n.split(".")[0]).alias("source"), F.col("_loaded_at").cast("timestamp").alias(
        "_loaded_at")) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_freshness(raw, names: list[str], now) -> DataFrame:
    """Q9 for every declared source that has tables in ``names``."""
    from ledgerlake.functions import hour_diff

    m = loaded_at_by_source(raw, names).groupBy("source").agg(F.max("_loaded_at").alias("max_loaded_at"))
    h = hour_diff(lit_ts(now), F.col("max_loaded_at"))
    warn = F.lit(None)
    err = F.lit(None)
    for s in SOURCES.values():
        warn = F.when(F.col("source") == s.name, s.warn_after_hours).otherwise(warn)
        err = F.when(F.col("source") == s.name, s.error_after_hours).otherwise(err)
    return m.select(
        "source", "max_loaded_at", h.alias("hours_since_load"),
        warn.alias("warn_after_hours"), err.alias("error_after_hours"),
        F.when(h.isNull() | (h > err), "error").when(h > warn, "warn").otherwise("pass").alias("status"),
    )
