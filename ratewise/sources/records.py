"""Metrics record and run report reads (S-8, S-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise import schemas
from ratewise.sources.store import path_exists


def _read_record(spark: SparkSession, path: str, schema) -> DataFrame:
    """A record of a few fields: one JSON object a file, indented or not."""
    return spark.read.schema(schema).option("multiLine", True).json(path).dropna(how="all")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """S-8: the metrics record, JSON (indented or not) or the three-line text
    form; an empty frame of the same schema when the record is missing (the
    caller shows the default text)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.METRICS)
    whole = spark.read.text(path, wholetext=True)

    def number(pattern: str, kind: str):
        return F.expr(f"try_cast(nullif(regexp_extract(value, r\"{pattern}\", 1), '') as {kind})")
    config = F.struct(number(r"'rank': *([0-9]+)", "int").alias("rank"),
                      number(r"'regParam': *([-+.0-9eE]+)", "double").alias("regParam"),
                      number(r"'maxIter': *([0-9]+)", "int").alias("maxIter"))
    lines = F.struct(config.alias("config"), number(r"validation *: *([-+.0-9eE]+)", "double").alias("rmse_validation"),
                     number(r"test final *: *([-+.0-9eE]+)", "double").alias("rmse_test"))
    record = F.when(F.trim("value").startswith("{"), F.from_json("value", schemas.METRICS)).otherwise(lines)
    return whole.select(record.alias("r")).select("r.*").dropna(how="all", subset=["rmse_validation", "rmse_test"])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """S-9: the run report, empty when missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.REPORT)
    return _read_record(spark, path, schemas.REPORT)
