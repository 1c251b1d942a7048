"""Hot-key split joins: same rows as a plain join, hot rows not shuffled."""

import pytest
from pyspark.sql import functions as F

from ratewise.operators.skew import hot_keys, split_hot_join


@pytest.fixture(scope="module")
def skewed(spark):
    # key "k0" holds a third of the rows; keys >= 400 have no side row
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("k0"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"),
        F.col("id").alias("v"))
    side = spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
                                   (F.col("id") * 10).alias("w"))
    return df, side


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_equals_plain_join(spark, skewed, how):
    df, side = skewed
    got = split_hot_join(df, side, "key", how=how, hot_rows=1000)
    want = df.join(side, "key", how)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_keys_bounded(spark, skewed):
    df, _ = skewed
    assert [r.key for r in hot_keys(df, "key", 1000).collect()] == ["k0"]


def test_hot_rows_are_salted(spark, skewed):
    df, side = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = split_hot_join(df, side, "key", hot_rows=1000)
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert "BroadcastHashJoin LeftOuter" in plan        # hot flag, map side
        assert "SortMergeJoin Inner" in plan and "_salt" in plan
        # the hot key's rows are spread over many salts, in many partitions
        from ratewise.operators.skew import salted_join, hot_keys
        spread = (salted_join(df.withColumn("pid", F.spark_partition_id()), side, "key", "inner",
                              hot_keys(df, "key", 1000), buckets=8)
                  .where("key = 'k0'").select(F.spark_partition_id().alias("p")).distinct().count())
        assert spread > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_equal_hot_rows_are_spread(spark):
    # a third of all lookups is one identical request
    from ratewise.operators.skew import salted_join
    req = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id").cast("int")).alias("user_id"), F.lit(5).alias("n"))
    side = spark.range(30_000).select(F.col("id").cast("int").alias("user_id"), F.lit("x").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = salted_join(req, side, "user_id", "left", hot_keys(req, "user_id", 5000), buckets=8)
        tasks = out.where("user_id = 1").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(tasks) > 1 and sum(t["count"] for t in tasks) == req.where("user_id = 1").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_wide_rows_are_not_broadcast(spark, skewed):
    df, side = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = split_hot_join(df, side, "key", side_rows=400, row_bytes=1 << 20)
        plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert "BroadcastHashJoin Inner" not in plan and "SortMergeJoin Inner" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_side_is_broadcast_whole(spark, skewed):
    df, side = skewed
    out = split_hot_join(df, side, "key", side_rows=400)
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert "LeftAnti" not in plan and "BroadcastHashJoin Inner" in plan


def test_salt_ignores_map_columns(spark):
    from ratewise.operators.skew import salted_join
    df = spark.range(2000).select(
        F.when(F.col("id") % 2 == 0, F.lit("k0")).otherwise(F.lit("k1")).alias("key"),
        F.create_map(F.lit("a"), F.col("id")).alias("m"))
    side = spark.createDataFrame([("k0", 1), ("k1", 2)], "key string, w int")
    hot = spark.createDataFrame([("k0",)], "key string")
    assert salted_join(df, side, "key", "inner", hot, buckets=4).count() == 2000
