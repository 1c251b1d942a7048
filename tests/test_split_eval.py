"""Hash split, RMSE, model choice."""

import math

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF01
from ratewise.operators import evaluate, split
from ratewise.plans.cleaning import run_cleaning
from ratewise.sources import fixtures


def test_split_is_layout_independent(spark):
    df = spark.range(0, 20000).select(
        (F.col("id") % 701).cast("int").alias("user_idx"),
        (F.col("id") % 113).cast("int").alias("product_idx"),
        F.lit(1.0).alias("Score"))
    a = split.assign_split(df)
    b = split.assign_split(df.repartition(17))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    total = sum(counts.values())
    assert abs(counts["train"] / total - 0.8) < 0.02
    assert abs(counts["validation"] / total - 0.1) < 0.02


def test_split_fixture_counts(spark):
    ratings = run_cleaning(fixtures.reviews(spark, SF01)).ratings
    counts = {r.split: r.n_rows for r in split.split_counts(ratings).collect()}
    assert sum(counts.values()) == 33585
    assert set(counts) == {"train", "validation", "test"}


def test_thresholds():
    assert split.thresholds((0.8, 0.1, 0.1)) == [8000, 9000, 10000]
    assert split.thresholds((1, 1)) == [5000, 10000]


def test_rmse_equals_mllib_evaluator(spark):
    df = spark.range(0, 1000).select(
        (F.col("id") % 5 + 1).cast("float").alias("Score"),
        (F.sin(F.col("id")) * 2 + 3).alias("prediction"))
    mine = evaluate.rmse(df)
    ref = RegressionEvaluator(metricName="rmse", labelCol="Score",
                              predictionCol="prediction").evaluate(df)
    assert math.isclose(mine, ref, rel_tol=1e-12)


def test_rmse_counts_dropped(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, None), (3.0, float("nan")), (4.0, 4.0)],
                               "Score double, prediction double")
    r = evaluate.rmse_frame(df, digits=None).first()
    assert (r.n_rows, r.n_scored, r.n_dropped) == (4, 2, 2)
    assert math.isclose(r.rmse, math.sqrt((0.25 + 0) / 2))


def test_pick_best_first_wins_tie(spark):
    m = spark.createDataFrame([(0, 0.9), (1, 0.8), (2, 0.8), (3, 0.85)],
                              "candidate int, rmse_validation double")
    assert evaluate.pick_best(m).first().candidate == 1


def test_scale_settings():
    from ratewise.session import scale_settings
    tb = 1 << 40
    s = scale_settings(100 * tb, cores=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 100_000          # capped
    assert scale_settings(1 << 30, cores=8)["spark.sql.shuffle.partitions"] == "16"
    assert scale_settings(64 << 30, cores=8)["spark.sql.shuffle.partitions"] == "256"
    assert s["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_choice_uses_exact_scores(spark):
    table = spark.createDataFrame([("validation", 0, 0, 1.00000049), ("validation", 1, 5, 1.00000010), ("test", 0, 0, 2.0),
                                   ("test", 1, 5, 3.0)], "split string, candidate int, damping int, rmse double")
    from ratewise.operators import evaluate
    assert evaluate.best_with_test(table).first().candidate == 1


def test_no_scored_row(spark):
    import math

    from ratewise.operators import evaluate
    none = spark.createDataFrame([], "Score float, prediction double")
    assert math.isnan(evaluate.rmse(none))


def test_als_blocks_follow_the_data_alone():
    from ratewise.operators import train
    assert [train.als_blocks(n) for n in (0, 1, 100_000, 100_001, 10**9)] == [1, 1, 1, 2, 10_000]


def test_rating_queries_join_the_ids_once(spark):
    """The ratings are read several times; the joins behind them run once."""
    from conftest import SF001
    from ratewise.plans import catalog
    kept = catalog._kept_ratings(spark, SF001)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Join" not in plan
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, catalog._ratings(spark, SF001).collect()))
