"""Append-only tables bucketed and sorted on their keys.

The files lie in a plain folder; the session's catalog is told the layout
again whenever a session first uses it, so no metastore is needed. A join of
a batch with such a table on the bucket columns shuffles the batch alone:
the table is read bucket by bucket, without an exchange.

Every append deals its rows to the buckets first and so adds one file per
bucket. ``buckets`` is fixed when a table is made; choose it so that a bucket
fits a task (target bytes / 256 MB).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.sinks.publish import Files

BUCKETS = 16
LAYOUT_FILE = "_buckets"


class BucketedTable:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.name = "bucketed_" + hashlib.md5(self.path.encode()).hexdigest()
        stored = Files(spark, self.path).read(f"{self.path}/{LAYOUT_FILE}")
        if stored:
            layout, self.schema = stored.split("\n", 1)
            number, by = layout.split(" ", 1)
            buckets = int(number)
            if by != ",".join(keys):
                raise ValueError(f"{path} is bucketed by {by}, not {keys}")
        else:
            self.schema = None
        self.buckets = buckets

    def exists(self) -> bool:
        return self.schema is not None

    def _register(self) -> None:
        if not self.spark.catalog.tableExists(self.name):
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {self.name} ({self.schema}) USING parquet CLUSTERED BY ({keys}) "
                           f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def read(self) -> DataFrame | None:
        if not self.exists():
            return None
        self._register()
        return self.spark.table(self.name)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt to the buckets: joined with the table, neither side is dealt again."""
        return rows.repartition(self.buckets, *self.keys)

    def append(self, rows: DataFrame, dealt: bool = False) -> None:
        """Add ``rows``; the first append makes the table with their schema. ``dealt``: they come from ``dealt``."""
        if not self.exists():
            self.schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            Files(self.spark, self.path).write(f"{self.path}/{LAYOUT_FILE}", f"{self.buckets} {','.join(self.keys)}\n{self.schema}")
        self._register()
        columns = self.spark.table(self.name).columns
        rows = rows.select(*columns)
        (rows if dealt else self.dealt(rows)).sortWithinPartitions(*self.keys).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
