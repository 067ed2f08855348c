import datetime as dt
import hashlib

from pyspark.sql import functions as F

from ledgerlake import functions as L
from ledgerlake.plans import marts
from ledgerlake.params import RunParams


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_surrogate_key_matches_md5_of_joined_parts(spark):
    got = one(spark, L.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(1)))
    want = hashlib.md5(f"a-{L.SURROGATE_NULL}-1".encode()).hexdigest()
    assert got == want


def test_surrogate_key_decimal_scale_is_part_of_the_key(spark):
    k1 = one(spark, L.surrogate_key(F.lit("12.5").cast("decimal(18,4)")))
    assert k1 == hashlib.md5(b"12.5000").hexdigest()


def test_split_part_is_null_out_of_range(spark):
    assert one(spark, L.split_part(F.lit("Ann Lee Park"), " ", 1)) == "Lee"
    assert one(spark, L.split_part(F.lit("Mono"), " ", 1)) is None
    assert one(spark, L.split_part(F.lit(None).cast("string"), " ", 0)) is None


def test_json_scalar_edge_cases(spark):
    cases = {
        '{"a": 1}': "1",
        '{"a": "x"}': "x",
        '{"a": {"b": 1}}': None,   # object where a scalar is expected
        '{"a": [1, 2]}': None,     # array
        '{"b": 1}': None,          # missing key
        '{"a": ': None,            # malformed
        '{"a": null}': None,
    }
    for doc, want in cases.items():
        assert one(spark, L.json_scalar(F.lit(doc), "$.a")) == want, doc


def test_json_array_path_skips_nulls(spark):
    assert one(spark, L.json_string_array_path(F.lit('["a", null, "b"]'), " > ")) == "a > b"


def test_week_of_year_is_sunday_based_like_strftime_U(spark):
    rows = L.date_spine(spark, "2020-01-01", "2031-01-01").select(
        "date_day", L.week_of_year_sunday("date_day").alias("w")).collect()
    assert len(rows) == 4018
    for r in rows:
        assert r.w == int(r.date_day.strftime("%U")), r.date_day


def test_month_and_hour_boundaries(spark):
    assert one(spark, L.month_boundaries(F.lit("2024-02-01").cast("date"), F.lit("2024-01-31").cast("date"))) == 1
    assert one(spark, L.month_boundaries(F.lit("2024-01-31").cast("date"), F.lit("2024-01-01").cast("date"))) == 0
    assert one(spark, L.hour_diff(L.lit_ts("2024-01-01 02:00:00"), L.lit_ts("2024-01-01 00:59:00"))) == 1


def test_pct_variance_zero_handling(spark):
    assert one(spark, L.pct_variance(F.lit(0), F.lit(0))) == 0.0
    assert one(spark, L.pct_variance(F.lit(5), F.lit(0))) == 100.0
    assert one(spark, L.pct_variance(F.lit(150), F.lit(-100))) == 250.0


def test_money_macros(spark):
    assert str(one(spark, L.cents_to_dollars(F.lit(12345)))) == "123.4500"
    assert one(spark, L.classify_amount(F.lit(-1))) == "credit"
    assert one(spark, L.classify_amount(F.lit(None).cast("int"))) == "zero"
    assert one(spark, L.safe_divide(F.lit(1), F.lit(0), default=-1)) == -1
    assert one(spark, L.safe_divide_null(F.lit(1), F.lit(0))) is None


def test_dim_date_spine_is_end_exclusive(spark):
    d = marts.dim_date(spark, RunParams())
    assert d.count() == 4017
    last = d.agg(F.max("date_key")).first()[0]
    assert last == dt.date(2030, 12, 30)
    row = d.filter(F.col("date_key") == "2024-01-31").first()
    assert row.is_today and row.days_ago == 0 and row.months_ago == 0
    assert row.day_name == "Wednesday" and row.year_quarter == "2024-Q1"
