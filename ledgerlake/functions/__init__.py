"""Reusable Column expressions (the reference's macro surface and scalar idioms).

Everything here returns a ``pyspark.sql.Column`` built from built-in functions,
so it stays inside whole-stage codegen; there is no Python UDF anywhere.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------
MONEY = DecimalType(18, 4)  # raw money amounts
RATE = DecimalType(18, 9)  # exchange rates
BASE = DecimalType(28, 9)  # base-currency amounts and the unified spine amount
PROB = DecimalType(18, 6)  # probability 0..1

# Fixed value: placeholder that surrogate keys hash in place of NULL
# (public dbt_utils generate_surrogate_key behaviour).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Keys (X25)
# ---------------------------------------------------------------------------
def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined string casts, NULL replaced by a fixed placeholder.

    Pass column names or Columns; wrap constants in ``F.lit``. Casts are the
    caller's contract: fix decimal scale before hashing so keys are stable.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# ---------------------------------------------------------------------------
# Money / arithmetic macros
# ---------------------------------------------------------------------------
def cents_to_dollars(c, out=MONEY) -> Column:
    """G1: integer cents -> decimal dollars."""
    return (_c(c).cast(DecimalType(18, 0)) / F.lit(100)).cast(out)


def safe_divide(num, den, default=0) -> Column:
    """``default`` when the denominator is 0 or NULL."""
    d = _c(den)
    return F.when((d == 0) | d.isNull(), F.lit(default)).otherwise(_c(num) / d)


def safe_divide_null(num, den) -> Column:
    """NULL on a zero denominator (BigQuery SAFE_DIVIDE)."""
    return F.try_divide(_c(num), _c(den))


def classify_amount(c) -> Column:
    """Debit (> 0) / credit (< 0) / zero (0 or NULL)."""
    x = _c(c)
    return F.when(x > 0, "debit").when(x < 0, "credit").otherwise("zero")


def pct_variance(actual, expected, digits: int = 2) -> Column:
    """|a - e| / |e| * 100 with 0/0 -> 0 and x/0 -> 100, as double."""
    a, e = _c(actual), _c(expected)
    ratio = F.abs(a - e).cast("double") / F.abs(e).cast("double") * 100.0
    return (
        F.when((e == 0) & (a == 0), F.lit(0.0))
        .when(e == 0, F.lit(100.0))
        .otherwise(F.round(ratio, digits))
    )


def count_present(*cols) -> Column:
    """Number of non-NULL columns."""
    return reduce(
        lambda acc, c: acc + c,
        [F.when(_c(c).isNotNull(), 1).otherwise(0) for c in cols],
    )


# ---------------------------------------------------------------------------
# Strings / JSON
# ---------------------------------------------------------------------------
def currency_code(c, default: str | None = None) -> Column:
    """upper(trim(c)), optionally defaulted."""
    x = F.trim(_c(c))
    if default is not None:
        x = F.coalesce(x, F.lit(default))
    return F.upper(x)


def split_part(c, delim: str, index: int) -> Column:
    """0-based element of split(), NULL when out of range (safe_offset)."""
    return F.get(F.split(_c(c), delim), index)


def _scalar_only(v: Column) -> Column:
    """NULL for the text of a nested object or array (a scalar extractor gives
    NULL there); the extra parse only runs for values starting with { or [."""
    first = F.substring(v, 1, 1)
    nested = F.when(
        first.isin("{", "["), F.json_object_keys(v).isNotNull() | F.json_array_length(v).isNotNull()
    ).otherwise(F.lit(False))
    return F.when(nested, F.lit(None).cast("string")).otherwise(v)


def json_scalar(c, path: str) -> Column:
    """JSON scalar at ``path``; NULL for objects/arrays and malformed JSON.

    Limitation: a *string* value whose text is itself a JSON object or array
    (e.g. ``"{}"``) is indistinguishable from a nested value here and is nulled too.
    """
    return _scalar_only(F.get_json_object(_c(c), path))


def json_scalars(c, fields: list[str]) -> dict[str, Column]:
    """X8 for several top-level fields: the document is parsed once per row
    (``from_json`` into a struct of strings) instead of once per field.
    Nested values come back as their JSON text and are nulled like ``json_scalar``;
    malformed documents give NULL for every field."""
    schema = "struct<" + ", ".join(f"`{f}`: string" for f in fields) + ">"
    parsed = F.from_json(_c(c), schema)
    return {f: _scalar_only(parsed.getField(f)) for f in fields}


def json_string_array_path(c, sep: str) -> Column:
    """X6 + X7: JSON array of strings -> 'a > b > c' (NULL elements skipped)."""
    arr = F.from_json(_c(c), "array<string>")
    return F.array_join(arr, sep)


# ---------------------------------------------------------------------------
# Dates (X13-X20)
# ---------------------------------------------------------------------------
def day_diff(later, earlier) -> Column:
    """Whole days between two dates."""
    return F.datediff(_c(later), _c(earlier))


def month_boundaries(later, earlier) -> Column:
    """Month boundaries crossed (Jan 31 -> Feb 1 is 1)."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) * 12 + F.month(a)) - (F.year(b) * 12 + F.month(b))


def hour_diff(later, earlier) -> Column:
    """Whole hours elapsed (truncated toward zero)."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def week_of_year_sunday(c) -> Column:
    """Sunday-start week number 0..53 (weeks before the first Sunday are 0)."""
    d = _c(c)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def date_spine(spark, start: str, end: str, name: str = "date_day"):
    """One row per day in [start, end) -- end exclusive."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(F.lit(start)),
                F.date_sub(F.to_date(F.lit(end)), 1),
                F.expr("interval 1 day"),
            )
        ).alias(name)
    )


def lit_date(d) -> Column:
    return F.to_date(F.lit(str(d)))


def lit_ts(ts) -> Column:
    s = ts if isinstance(ts, str) else ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(s))


def null_of(type_name: str) -> Column:
    """Typed NULL for union padding."""
    return F.lit(None).cast(type_name)
