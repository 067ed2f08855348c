"""Integer vectors, which the vector operators compute on exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: components stop at plus or minus this, so that squared distances of up to 512 components fit a long
LARGEST = 1 << 26


def finite(vector: Column) -> Column:
    """Not null, and neither are the components, which are all finite."""
    bound = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < bound))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component x, as array<int>."""
    top = F.lit(float(LARGEST))
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, -top), top)).cast("int"))


def exact_long(total: Column) -> Column:
    """A decimal total as long; null where it has no place there."""
    return total.try_cast("long")


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """vec_id, vector (integers) and ``more`` of the rows whose vector is whole and finite."""
    rows = df.filter(finite(F.col(vector_col)))
    return rows.select(F.col(id_col).alias("vec_id"), integers(F.col(vector_col)).alias("vector"), *more)
