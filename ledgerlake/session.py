"""SparkSession settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Applied on top of whatever the cluster sets; every value is a standard
# Spark SQL option.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffles start in many parts and AQE joins small ones up to the advisory size: a task's rows
    # follow the data, not the cluster's shuffle.partitions, so its sorts and hash maps stay in memory
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    # a full rebuild replaces every partition; the merge asks for dynamic overwrite itself
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake",
                  clean_checkpoints: bool = True) -> SparkSession:
    """Local session for tests and the benchmark (UI off, no server).

    ``clean_checkpoints`` removes checkpoint files once their DataFrame is
    garbage collected; the deletes run in the background, so a short timed
    run (the benchmark) turns it off."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", str(clean_checkpoints).lower())
        .config("spark.ui.showConsoleProgress", "false")
        # no call sites for every Column made: they are several driver calls each, and the jobs make thousands
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark) -> str:
    """The session's checkpoint folder. A session without one, as in tests,
    gets a temporary one."""
    found = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found or tempfile.mkdtemp(prefix="ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df):
    """``df`` from a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only when the session has none (local tests) is ``fallback`` installed.
    """
    d = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d is None and fallback is not None:
        spark.sparkContext.setCheckpointDir(fallback)
        d = spark.sparkContext.getCheckpointDir()
    return d
