"""O1-O3: an order that is part of the result.

``orderBy`` orders the rows of a frame, but a table that is written and read
again has no order. ``ranked`` numbers the rows in the order instead: a
range sort deals them out, every partition numbers its own, and only the
partitions' row counts (one row each) meet to shift the numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import cut


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with its 1-based position in ``order``; give a whole order (ties are numbered in any order)."""
    part, row = "_ranked_part", "_ranked_row"
    # the low 33 bits of the id number a partition's rows
    numbered = cut(df.orderBy(*order).withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}))
    sizes = numbered.groupBy(part).count()
    before = sizes.select(part, (F.sum("count").over(Window.orderBy(part)) - F.col("count")).alias("_ranked_before"))
    number = F.col("_ranked_before") + F.col(row).bitwiseAND((1 << 33) - 1) + 1
    return numbered.join(F.broadcast(before), part).withColumn(name, number).drop(part, row, "_ranked_before")
