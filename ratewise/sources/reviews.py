"""Review file scans (S-1, S-2) and the cleaned outputs read back (S-3, S-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import schemas
from ratewise.sources.csv_blocks import read_csv_blocks


def typed_reviews(raw: DataFrame) -> DataFrame:
    """Bind the four review columns by name and cast without failing.

    ``try_cast`` turns a bad ``Score`` / ``Time`` into null (Spark 4 ANSI
    ``cast`` would abort the job); the nulls are removed by ``drop_nulls``.
    """
    cols = []
    for field in schemas.REVIEW.fields:
        cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
    return raw.select(*cols)


def read_review_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """CSV with a header; quoted fields may hold doubled quotes and newlines.

    All columns are read as strings (no inference pass over the data), then
    the four used columns are selected by header name so the others are not
    parsed.  Large files are read by many tasks (``csv_blocks``); set
    ``multiline=False`` when the text is known to hold no embedded newline:
    one pass over the lines instead of two.
    """
    if multiline:
        return typed_reviews(read_csv_blocks(spark, path))
    raw = (spark.read
           .option("header", True)
           .option("quote", '"')
           .option("escape", '"')
           .option("mode", "PERMISSIVE")
           .csv(path))
    return typed_reviews(raw)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """S-3: cleaned ratings ``(user_idx, product_idx, Score)``."""
    return spark.read.parquet(path).select("user_idx", "product_idx", "Score")


def read_user_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """S-4: ``(UserId, user_idx)``, projected and made distinct."""
    return spark.read.parquet(path).select("UserId", "user_idx").distinct()


def read_product_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("ProductId", "product_idx").distinct()
