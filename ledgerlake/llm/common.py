"""Helpers the operators of this folder share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: fixed value: the white space of the contracts, space and U+0009..U+000D
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; a temporary
    one is set only where none is, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` from a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from Parquet files in a new folder of the shared one: less disk than a checkpoint, and columns can be read apart."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def slices(batch, column: int, rows: int = 1024, size: int = 4 << 20):
    """Parts of an Arrow batch of few rows and, but for single texts, few bytes."""
    lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(lengths):
        if i > start and (i - start >= rows or held + n > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if batch.num_rows > start:
        yield batch.slice(start)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` plus its 0-based position in ``order``.

    A range-partitioned sort numbers the rows of each partition; only the
    partitions' row counts (one row per partition) meet in one place.
    """
    part, seq = "_gr_part", "_gr_seq"
    ordered = cut(df.orderBy(*order).withColumn(part, F.spark_partition_id())
                  .withColumn(seq, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    sizes = ordered.groupBy(part).count()
    before = sizes.select(part, (F.sum("count").over(Window.orderBy(part)) - F.col("count")).alias("_gr_before"))
    return (ordered.join(F.broadcast(before), part)
            .withColumn(name, F.col("_gr_before") + F.col(seq)).drop(part, seq, "_gr_before"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of ``parts``: 52 bits, the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
