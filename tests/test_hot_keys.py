"""Hot keys: the same results whether or not a key counts as hot."""

import pytest
from pyspark.sql import Window, functions as F

from invoicemill.operators import hot_keys as hk


@pytest.fixture(scope="module")
def facts(spark):
    # a third of the rows on key 'a', some on NULL, one without a match
    return spark.range(300).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 50 == 1, None)
        .when(F.col("id") == 7, "zz").otherwise(F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))).alias("key"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame([("a", 1, "x"), ("h1", 2, "y")] + [(f"k{i}", i + 10, None) for i in range(20)],
                                 "key string, n int, note string")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("hot_rows", [5, 50, 10**6])
def test_join_to_unique(spark, facts, dimension, how, hot_rows):
    got = hk.join_to_unique(facts, dimension, "key", spread=["id"], how=how, hot_rows=hot_rows)
    want = facts.join(dimension, "key", how).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_rows_are_spread(spark, facts, dimension):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hk.join_to_unique(facts, dimension, "key", spread=["id"], hot_rows=50)
        tasks = joined.where("key = 'a'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(tasks) == 8 and max(r["count"] for r in tasks) < 30


def test_dense_numbers(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"), "id").repartition(7, "id")
    got = hk.dense_numbers(df, ["k"], "n")
    want = df.withColumn("n", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_dense_numbers_of_nothing(spark):
    assert hk.dense_numbers(spark.range(0), ["id"], "n").count() == 0


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_numbers_within(spark, hot_rows):
    # group 0 is hot and most of its rows are copies of one row
    df = spark.range(500).select(F.when(F.col("id") % 5 < 2, 0).otherwise(F.col("id") % 7 + 1).alias("g"),
                                 F.when(F.col("id") % 5 == 1, 9).otherwise(F.col("id") % 13).alias("v"))
    got = hk.numbers_within(df, "g", ["v"], "n", hot_rows=hot_rows, copies_per_row=8)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v")))
    assert sorted(map(tuple, got.select("g", "v", "n").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_hot_key_without_a_match_is_spread(spark, how):
    rows = spark.range(2000).select("id", F.lit("nobody").alias("key"))
    side = spark.createDataFrame([("a", 1)], "key string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hk.join_to_unique(rows, side, "key", spread=["id"], how=how, hot_rows=50)
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (len(tasks), sum(r["count"] for r in tasks)) == ((8, 2000) if how == "left" else (0, 0))
    assert all(r["count"] < 400 for r in tasks)


def test_every_hot_key_is_split(spark):
    counts = spark.range(1500).select(F.col("id").alias("key"), F.lit(60).alias("row_count"))
    assert hk.hot_keys(counts, "key", 50).count() == 1500
