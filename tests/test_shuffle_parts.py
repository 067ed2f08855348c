from pyspark.sql import functions as F

from ledgerlake.operators.joins import left_join_spread
from ledgerlake.session import configure

CONF = {
    "spark.sql.shuffle.partitions": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def test_a_join_task_reads_about_the_advisory_size_whatever_the_cluster_deals(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        configure(spark)
        left = spark.range(40000).select(F.col("id").alias("row"), F.concat(F.lit("k"), F.col("id") % 9000).alias("key"), F.md5(F.col("id").cast("string")).alias("memo"))
        right = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("other"), F.col("id").alias("n"))
        joined = left_join_spread(left, right, [("key", "other")], spread_col="row")
        tasks = joined.groupBy(F.spark_partition_id()).agg(F.max("memo")).count()
        small = left_join_spread(left.limit(10), right.limit(10), [("key", "other")], spread_col="row")
        few = small.groupBy(F.spark_partition_id()).count().count()
        assert joined.filter("n is not null and concat('k', n) = key").count() == 40000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert tasks > 10
    assert few <= 2
