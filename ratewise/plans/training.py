"""Training job: cleaned ratings -> grid-selected ALS model, metrics record,
top-k lists for every user."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config
from ratewise.config import AlsSettings
from ratewise.operators import train
from ratewise.operators.report import metrics_text
from ratewise.sinks.writers import write_record


@dataclass
class TrainingOutput:
    result: train.GridResult
    metrics: DataFrame
    lists: DataFrame


def run_training(ratings: DataFrame, grid=config.ALS_GRID, settings: AlsSettings = AlsSettings(),
                 k: int = config.TOP_K) -> TrainingOutput:
    result = train.train_from_ratings(ratings, grid, settings)
    return TrainingOutput(result=result, metrics=train.metrics_record(result),
                          lists=train.recommend_all(result.model, k))


def write_training(out: TrainingOutput, out_dir: str) -> dict[str, str]:
    """K-5 model, K-6 metrics record (JSON and text), all-user lists as Parquet."""
    paths = {"model": os.path.join(out_dir, "als_model"),
             "metrics": os.path.join(out_dir, "metrics"),
             "metrics_text": os.path.join(out_dir, "metrics_text"),
             "lists": os.path.join(out_dir, "all_user_lists.parquet")}
    train.save_model(out.result.model, paths["model"])
    write_record(out.metrics, paths["metrics"])
    # the same record in the reference's three-line text form
    text = metrics_text(out.metrics).select(
        F.regexp_replace("rmse_info", "\n$", "").alias("value"))  # the writer ends the line
    text.coalesce(1).write.mode("overwrite").text(paths["metrics_text"])
    out.lists.write.mode("overwrite").parquet(paths["lists"])
    return paths
