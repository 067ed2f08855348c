from pyspark.sql import functions as F

from ledgerlake.operators.ordering import ranked


def test_rank_is_the_place_in_the_whole_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"), F.when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 5).alias("g"))
    got = [(r.g, r.v) for r in sorted(ranked(df, [F.col("g").desc_nulls_last(), F.col("v")]).collect(), key=lambda r: r["rank"])]
    want = sorted(got, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    assert got == want
    assert sorted(r["rank"] for r in ranked(df, [F.col("v")]).collect()) == list(range(1, 1001))
    assert ranked(df.limit(0), [F.col("v")]).count() == 0
