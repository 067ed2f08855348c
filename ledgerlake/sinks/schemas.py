"""Which schema a table has after a batch.

* a column only the batch has is added at the end; older rows read as NULL;
* a column only the table has stays; the batch's rows get NULL;
* a column both have takes the wider type: integers into longer integers,
  float into double, integers and decimals into decimals that hold both;
  the narrower side is read or cast up;
* any other difference is an error, and nothing is written.

The schema is kept in a file of the table's folder, so old files with
narrower types or fewer columns are read under it without touching them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
                               StructField, StructType)

from ledgerlake.sinks.publish import SCHEMA_FILE, Files

INTEGERS = [ByteType, ShortType, IntegerType, LongType]
#: decimal digits that an integer type needs
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds both without loss, or None."""
    if a == b:
        return a
    kinds = (type(a), type(b))
    if all(k in INTEGERS for k in kinds):
        return max((a, b), key=lambda t: INTEGERS.index(type(t)))
    if set(kinds) == {FloatType, DoubleType}:
        return DoubleType()
    if DecimalType in kinds and all(k is DecimalType or k in DIGITS for k in kinds):
        a, b = (t if isinstance(t, DecimalType) else DecimalType(DIGITS[type(t)], 0) for t in (a, b))
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def reconciled(table: StructType, batch: StructType) -> StructType:
    new = {f.name: f for f in batch}
    fields = []
    for f in table:
        other = new.pop(f.name, None)
        kind = wider(f.dataType, other.dataType) if other else f.dataType
        if kind is None:
            raise TypeError(f"column {f.name}: {other.dataType.simpleString()} does not fit {f.dataType.simpleString()}")
        fields.append(StructField(f.name, kind, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in batch if f.name in new])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    import json

    text = Files(spark, path).read(f"{path}/{SCHEMA_FILE}")
    return StructType.fromJson(json.loads(text)) if text else None
