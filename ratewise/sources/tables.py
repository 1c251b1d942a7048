"""Parquet tables of a data directory (one ``<name>.parquet`` each)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(base_dir: str, name: str) -> str:
    return os.path.join(base_dir, f"{name}.parquet")


def read_table(spark: SparkSession, base_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan; naming columns here keeps the ReadSchema narrow even
    before the optimizer prunes."""
    df = spark.read.parquet(table_path(base_dir, name))
    return df.select(*columns) if columns else df
