"""Model operators on Spark MLlib (M-2 .. M-6, S-7, K-5).

ALS itself is MLlib's (blocked, one factor shuffle each way per
iteration).  What is added around it: a fixed seed (Q6), cold-start
``drop`` (M-4), the reproducible split, one fit per configuration (Q4),
train/validation persisted once for the whole grid, checkpointing of the
factor lineage into the session's shared checkpoint folder, fitted models kept
as files so that a fit's shuffles can go, and a metrics DataFrame with the
choice rule of A-7.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config, schemas
from ratewise.config import AlsSettings
from ratewise.operators import clean, evaluate, split, topk
from ratewise.session import checkpoint_dir, drop_unused, materialise, scratch_dir


def make_als(rank: int, reg: float, max_iter: int,
             settings: AlsSettings = AlsSettings()) -> ALS:
    """M-2: explicit-rating ALS over (user_idx, product_idx, Score)."""
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg,
              userCol="user_idx", itemCol="product_idx", ratingCol="Score",
              coldStartStrategy=settings.cold_start, seed=settings.seed,
              checkpointInterval=settings.checkpoint_interval,
              intermediateStorageLevel="MEMORY_AND_DISK",
              finalStorageLevel="MEMORY_AND_DISK")
    if settings.num_user_blocks:
        als.setNumUserBlocks(settings.num_user_blocks)
    if settings.num_item_blocks:
        als.setNumItemBlocks(settings.num_item_blocks)
    for k, v in settings.extra.items():
        als.set(als.getParam(k), v)
    return als


def als_blocks(n_ratings: int) -> int:
    """Blocks per side, from the data alone: the same ratings give the same
    model on any cluster, and a block's ratings stay bounded."""
    return max(1, math.ceil(n_ratings / config.RATINGS_PER_ALS_BLOCK))


def grid_workers(spark, n_ratings: int, n_configs: int, settings: AlsSettings) -> int:
    """Concurrent fits: about two cores' worth of blocks per core.  On a
    cluster where each fit already has a block per core this is 2 (the
    second fit fills the gaps between the first one's iterations)."""
    if settings.concurrency:
        return max(1, min(n_configs, settings.concurrency))
    par = spark.sparkContext.defaultParallelism
    blocks = settings.num_user_blocks or als_blocks(n_ratings)
    return max(1, min(n_configs, math.ceil(2 * par / blocks)))


def fit(train: DataFrame, rank: int, reg: float, max_iter: int,
        settings: AlsSettings = AlsSettings(), n_ratings: int | None = None) -> ALSModel:
    spark = train.sparkSession
    checkpoint_dir(spark)  # ALS checkpoints factor RDDs there
    als = make_als(rank, reg, max_iter, settings)
    blocks = als_blocks(train.count() if n_ratings is None else n_ratings)
    if not settings.num_user_blocks:
        als.setNumUserBlocks(blocks)
    if not settings.num_item_blocks:
        als.setNumItemBlocks(blocks)
    return als.fit(train)


def stored(model: ALSModel, name: str = "fit") -> ALSModel:
    """The model read back from the shared scratch folder.  A fitted model's
    factors hang on the shuffles of the last iterations, each with a factor
    per rating on disk; the files hold one per user and product.  Spark's
    cleaner removes shuffles that the JVM's collector finds unused."""
    spark = model.userFactors.sparkSession
    path = scratch_dir(spark, name)
    save_model(model, path)
    return load_model(path)


def predict(model: ALSModel, df: DataFrame) -> DataFrame:
    """M-3: adds ``prediction``; rows of unseen users / items are dropped
    (M-4, ``coldStartStrategy='drop'``)."""
    return model.transform(df)


@dataclass
class GridResult:
    metrics: DataFrame      # candidate, rank, regParam, maxIter, rmse_validation
    best: dict              # the chosen row
    model: ALSModel
    rmse_test: float


def grid_search(train: DataFrame, validation: DataFrame, test: DataFrame,
                grid: Sequence[tuple[int, float, int]] = config.ALS_GRID,
                settings: AlsSettings = AlsSettings()) -> GridResult:
    """M-5 + A-7 + M-6: one fit per configuration (each on the persisted
    train set, run as concurrent jobs), validation RMSE per fit, least RMSE
    wins with the first on a tie, reported with its test RMSE.  Validation
    and test rows go through one join with a fit's factors: these are most of
    what an evaluation shuffles, whatever the held-out rows."""
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    held = validation.withColumn("split", F.lit("validation")).unionByName(
        test.withColumn("split", F.lit("test"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train = train.count()  # fills the cache; sizes the ALS blocks
        drop_unused(spark)  # the shuffles that made the ratings

        def run(cfg):
            rank, reg, iters = cfg
            m = stored(fit(train, rank, reg, iters, settings, n_ratings=n_train))
            drop_unused(spark)
            return m, evaluate.rmse_by(predict(m, held), "split")

        # fits are independent and seeded: run them as concurrent Spark jobs
        # so small fits fill the idle cores (same results as one by one)
        with ThreadPoolExecutor(grid_workers(spark, n_train, len(grid), settings)) as pool:
            fitted = list(pool.map(run, grid))
        rows = [(i, rank, float(reg), iters, float(r.get("validation", math.nan)))
                for i, ((rank, reg, iters), (_, r)) in enumerate(zip(grid, fitted))]
        models = [m for m, _ in fitted]
        metrics = spark.createDataFrame(
            rows, "candidate int, rank int, regParam double, maxIter int, rmse_validation double")
        best = evaluate.pick_best(metrics).first().asDict()
        model = models[best["candidate"]]
        rmse_test = fitted[best["candidate"]][1].get("test", math.nan)
    finally:
        train.unpersist()
        held.unpersist()
    drop_unused(spark)  # the joins of the evaluations
    return GridResult(metrics=metrics, best=best, model=model, rmse_test=float(rmse_test))


def labelled_ratings(ratings: DataFrame) -> DataFrame:
    """P-6 / P-7 null guard and M-1 split, written once: a reader of one split
    filters on its name and doesn't hash every key pair again."""
    cols = ["user_idx", "product_idx", "Score"]
    usable = clean.require_not_null(clean.drop_nulls(ratings, cols), cols)
    return materialise(split.assign_split(usable), "split")


def train_labelled(labelled: DataFrame, grid=config.ALS_GRID,
                   settings: AlsSettings = AlsSettings()) -> GridResult:
    """The grid over ``labelled_ratings``."""
    parts = split.labelled_frames(labelled)
    return grid_search(parts["train"], parts["validation"], parts["test"], grid, settings)


def train_from_ratings(ratings: DataFrame, grid=config.ALS_GRID,
                       settings: AlsSettings = AlsSettings()) -> GridResult:
    """P-6 / P-7 null guard, M-1 split, then the grid."""
    return train_labelled(labelled_ratings(ratings), grid, settings)


def metrics_record(result: GridResult) -> DataFrame:
    """K-6 content: best configuration and both RMSEs (4 decimals)."""
    b = result.best
    spark = result.metrics.sparkSession
    row = [((int(b["rank"]), float(b["regParam"]), int(b["maxIter"])),
            round(float(b["rmse_validation"]), 4), round(result.rmse_test, 4))]
    return spark.createDataFrame(row, schemas.METRICS)


def save_model(model: ALSModel, path: str) -> None:
    """K-5: overwrite."""
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """S-7."""
    return ALSModel.load(path)


def recommend_all(model: ALSModel, k: int = config.TOP_K, method: str = "blocked") -> DataFrame:
    """R-3 / J-6: ``(user_idx, recommendations)`` for every user.

    ``blocked`` uses the engine's scorer (deterministic ties, block size
    from the data); ``mllib`` calls ``recommendForAllUsers``.
    """
    if method == "mllib":
        return model.recommendForAllUsers(k)
    return topk.top_lists_by_dot(model.userFactors, model.itemFactors, k)


def recommend_subset(model: ALSModel, users: DataFrame, k: int = config.TOP_K,
                     method: str = "blocked", n_users: int | None = None,
                     n_items: int | None = None) -> DataFrame:
    """R-4 / J-5: lists for the distinct ``user_idx`` of ``users``."""
    if method == "mllib":
        return model.recommendForUserSubset(users.select("user_idx").distinct(), k)
    sub = topk.subset_factors(model.userFactors, users, requested_rows=n_users)
    return topk.top_lists_by_dot(sub, model.itemFactors, k, n_users=n_users, n_items=n_items)


def flat_lists(lists: DataFrame) -> DataFrame:
    """``(user_idx, rank, product_idx, rating)`` from list form."""
    return (lists.select("user_idx", F.posexplode("recommendations").alias("pos", "r"))
                 .select("user_idx", (F.col("pos") + 1).cast("int").alias("rank"),
                         F.col("r.product_idx").alias("product_idx"),
                         F.col("r.rating").alias("rating")))
