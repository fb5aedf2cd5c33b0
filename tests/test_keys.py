import pytest
from pyspark.sql import functions as F

from askloom.operators.keys import dedup_latest, first_per_key, row_index, skew_join


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_row_index_is_the_global_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    got = row_index(df, ["k"])
    assert got.where("k <> row_index").count() == 0 and got.count() == 5000


def test_row_index_of_nothing(spark):
    assert row_index(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_is_the_plain_join(spark, how):
    # A third of the rows has one key, another third none.
    n = F.col("id") % 3
    key = F.when(n == 0, F.lit(1)).when(n == 1, F.lit(None)).otherwise(F.col("id") % 50)
    left = spark.range(3000).select(key.cast("int").alias("k"), "id")
    right = spark.range(40).select((F.col("id") % 30).cast("int").alias("k"), F.col("id").alias("r"))
    assert rows(skew_join(left, right, ["k"], how, hot_rows=100)) == rows(left.join(right, "k", how))
    assert rows(skew_join(left, right, ["k"], how, hot_rows=100, max_hot=1)) == rows(
        left.join(right, "k", how)
    )


def test_hot_key_is_spread(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x")], "k int, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left, right, ["k"], hot_rows=200)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 4000 and len(sizes) >= 5


def test_skew_join_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        skew_join(spark.range(1), spark.range(1), ["id"], "full")


def test_dedup_keeps_the_newest_per_hour(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 10:05:00", 1), ("a", "2024-01-01 10:55:00", 2),
         ("a", "2024-01-01 11:00:00", 3), (None, "2024-01-01 10:00:00", 4),
         (None, "2024-01-01 10:00:01", 5)],
        "k string, t string, v int",
    ).withColumn("timestamp", F.to_timestamp("t"))
    hourly = dedup_latest(df, ["k"], granularity="hour")
    assert sorted(r.v for r in hourly.collect()) == [2, 3, 5]
    assert sorted(r.v for r in dedup_latest(df, ["k"]).collect()) == [3, 5]
    assert rows(dedup_latest(hourly, ["k"], granularity="hour")) == rows(hourly)
    assert hourly.columns == df.columns


def test_dedup_refuses_other_granularities(spark):
    with pytest.raises(ValueError, match=r"granularity must be one of \['hour'\] or None, but got day"):
        dedup_latest(spark.range(1), ["id"], granularity="day")


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    plan = first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
