"""JSON documents as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_entries(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """X7 + X8 for keys nobody knows beforehand: one row (``keep``, field, value,
    is_nested) per top-level key of the JSON object in ``col``.

    The document is parsed once, as VARIANT. Values are text; a nested object
    or array is its JSON text with ``is_nested`` true (here a string that
    merely looks like JSON is told apart from a nested value), a JSON null is
    NULL, decimals lose trailing zeros. Malformed documents, documents with a
    key twice, NULL, and roots that are no object give no row.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(col)).alias("_doc"))
    entry = df.sparkSession.tvf.variant_explode(F.col("_doc").outer())
    kind = F.schema_of_variant(F.col("_value"))
    rows = parsed.lateralJoin(entry.select(F.col("key").alias("field"), F.col("value").alias("_value"))).filter(F.col("field").isNotNull())
    return rows.select(*keep, "field", F.try_variant_get("_value", "$", "string").alias("value"),
                       (kind.startswith("OBJECT") | kind.startswith("ARRAY")).alias("is_nested"))
