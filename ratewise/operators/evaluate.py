"""Prediction quality and model choice (A-6, A-7, A-13).

RMSE is one distributed aggregate (partial sums per task), equal to MLlib's
``RegressionEvaluator`` but also reporting how many rows had no prediction
(cold start) instead of dropping them silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.skew import split_hot_join


def _usable(pred: str):
    p = F.col(pred)
    return F.when(p.isNotNull() & ~F.isnan(p), p)


def rmse_frame(df: DataFrame, label: str = "Score", prediction: str = "prediction",
               digits: int | None = 6) -> DataFrame:
    """One row: ``n_rows, n_scored, n_dropped, rmse``.

    Rows whose prediction is null or NaN count as dropped (A-13), as with
    ``coldStartStrategy="drop"``.
    """
    p = _usable(prediction)
    err2 = F.pow(F.col(label).cast("double") - p, 2)
    rmse = F.sqrt(F.avg(err2))
    if digits is not None:
        rmse = F.round(rmse, digits)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(p).alias("n_scored"),
        (F.count(F.lit(1)) - F.count(p)).alias("n_dropped"),
        rmse.alias("rmse"),
    )


def rmse(df: DataFrame, label: str = "Score", prediction: str = "prediction") -> float:
    """Scalar RMSE (one aggregate job); NaN when no row was scored."""
    found = rmse_frame(df, label, prediction, digits=None).first()["rmse"]
    return float("nan") if found is None else found


def rmse_by(df: DataFrame, by: str, label: str = "Score", prediction: str = "prediction") -> dict:
    """``rmse`` of each value of ``by`` (a few, like split names) in one aggregate
    job; a value without a scored row is missing or NaN."""
    err2 = F.pow(F.col(label).cast("double") - _usable(prediction), 2)
    rows = df.groupBy(by).agg(F.sqrt(F.avg(err2)).alias("rmse")).collect()
    return {r[by]: float("nan") if r["rmse"] is None else r["rmse"] for r in rows}


def pick_best(metrics: DataFrame, score: str = "rmse_validation",
              ordinal: str = "candidate") -> DataFrame:
    """A-7: the candidate with the least score; on a tie the first one
    (lowest ordinal) wins, like a strict ``<`` scan."""
    cols = metrics.columns
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(score), F.col(ordinal)))
    return metrics.agg(best.alias("_b")).select("_b.*")


def item_mean_predictor(train: DataFrame, damping: float = 0.0, item: str = "product_idx",
                        label: str = "Score") -> DataFrame:
    """Fixture predictor for exact checks: damped item mean
    ``(sum + d * mu) / (n + d)`` with ``mu`` the global train mean.

    ``mu`` is one scalar (collected); the per-item table is an aggregate.
    """
    mu = train.agg(F.avg(F.col(label).cast("double")).alias("mu")).first()["mu"] or 0.0
    return (train.groupBy(item)
                 .agg(((F.sum(F.col(label).cast("double")) + F.lit(damping * mu))
                       / (F.count(F.lit(1)) + F.lit(damping))).alias("prediction")))


def predict_with(table: DataFrame, df: DataFrame, item: str = "product_idx") -> DataFrame:
    """J-4 form for a per-item predictor: left join, missing -> null.  A
    popular item's rows are joined in place (``split_hot_join``)."""
    return split_hot_join(df, table, item, how="left")


def candidate_table(train: DataFrame, held: DataFrame, dampings: Sequence[float],
                    item: str = "product_idx", label: str = "Score") -> DataFrame:
    """RMSE (not rounded) of every damped-mean candidate on every split of
    ``held`` (a ``split`` column): rows ``(split, candidate, damping, rmse)``.

    One pass for all candidates and splits: the per-item (sum, count)
    table is built once, joined once (popular items salted), and every
    candidate's squared error is a column of one aggregate by split.
    """
    mu = train.agg(F.avg(F.col(label).cast("double")).alias("mu")).first()["mu"] or 0.0
    stats = train.groupBy(item).agg(F.sum(F.col(label).cast("double")).alias("_s"),
                                     F.count(F.lit(1)).alias("_n"))
    j = split_hot_join(held, stats, item, how="left")
    y = F.col(label).cast("double")
    aggs = []
    for i, d in enumerate(dampings):
        pred = (F.col("_s") + F.lit(d * mu)) / (F.col("_n") + F.lit(d))
        aggs.append(F.sqrt(F.avg(F.pow(y - pred, 2))).alias(f"_r{i}"))
    per_split = j.groupBy("split").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).cast("int").alias("candidate"),
                              F.lit(int(d)).cast("int").alias("damping"),
                              F.col(f"_r{i}").alias("rmse"))
                     for i, d in enumerate(dampings)])
    return per_split.select("split", F.inline(rows))


def candidate_metrics(train: DataFrame, validation: DataFrame,
                      dampings: Sequence[float], item: str = "product_idx",
                      label: str = "Score", digits: int = 6) -> DataFrame:
    """Validation RMSE of each damped-mean candidate, one row each."""
    held = validation.withColumn("split", F.lit("validation"))
    return (candidate_table(train, held, dampings, item, label)
            .select("candidate", "damping", F.round("rmse", digits).alias("rmse_validation")))


def best_with_test(table: DataFrame) -> DataFrame:
    """A-7 then M-6 from a ``candidate_table`` over validation and test:
    the least exact validation RMSE wins (first on a tie), reported with its
    test RMSE, both rounded for output."""
    wide = table.groupBy("candidate", "damping").agg(
        F.max(F.when(F.col("split") == "validation", F.col("rmse"))).alias("rmse_validation"),
        F.max(F.when(F.col("split") == "test", F.col("rmse"))).alias("rmse_test"))
    return pick_best(wide).withColumns({c: F.round(c, 6) for c in ("rmse_validation", "rmse_test")})
