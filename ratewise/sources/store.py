"""Recommendation store scan (S-6, F-11, F-13, A-10).

Reads every ``*.json`` file below a folder, at any depth, once (the
reference globbed the top level twice).  Each line is parsed on its own, once,
into a VARIANT: blank lines are skipped, a malformed line or one without
``user_idx`` is dropped without losing the rest of its file.  The list may use
any of the three element encodings, mixed too; it is normalised to
``array<struct<product_idx int, rating float>>``.  The batch id comes from the ``batch_id=<n>``
folder when present; file time and path order the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions import scalars as S

# numbers that the JSON writers of some languages leave bare
_BARE = r"(?<=[:,\[] ?)(NaN|-?Infinity)(?= ?[,\]}])"


def _parsed(line):
    """The line as VARIANT; one that isn't JSON only for bare NaN or Infinity
    is read with these as text (a cast gives the number back)."""
    strict = F.try_parse_json(line)
    return F.coalesce(strict, F.when(line.rlike("NaN|Infinity"), F.try_parse_json(F.regexp_replace(line, _BARE, '"$1"'))))


def read_store(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """A folder, or a list of files: ``(user_idx, recommendations, batch_id, run_id, file_time, file_path)``."""
    raw = (spark.read.option("recursiveFileLookup", True)
           .option("pathGlobFilter", glob)
           .text(path)
           .select("value",
                   F.col("_metadata.file_path").alias("file_path"),
                   F.col("_metadata.file_modification_time").alias("file_time")))
    lines = raw.where(S.non_blank("value"))
    parsed = (lines.select(_parsed(F.trim("value")).alias("j"), "file_path", "file_time")
              .withColumn("user_idx", S.variant_field(F.col("j"), "$.user_idx", "int")))
    from_dir = F.regexp_extract("file_path", r"batch_id=(\d+)", 1)
    run_id = F.regexp_extract("file_path", r"run_id=([^/]+)/", 1)
    elements = S.variant_field(F.col("j"), "$.recommendations", "array<variant>")
    return (parsed.where(F.col("user_idx").isNotNull())
                  .select("user_idx",
                          F.coalesce(S.normalise_elements(elements),
                                     F.array().cast("array<struct<product_idx: int, rating: float>>")).alias("recommendations"),
                          F.coalesce(S.variant_field(F.col("j"), "$.batch_id", "long"),
                                     F.when(from_dir != "", from_dir.cast("long"))).alias("batch_id"),
                          run_id.alias("run_id"), "file_time", "file_path"))


# run ids begin with the run's start time; files without one are older
STORE_ORDER = ("run_id", "batch_id", "file_time", "file_path")


def count_files(spark: SparkSession, path: str, glob: str = "*.json") -> int:
    """A-10: files found, each path once (the reference counted top-level
    files twice).  Only the listing is read (``binaryFile`` with the content
    column pruned).  Zero-byte files are not counted: Spark's file scans
    skip them, and they hold no list."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", glob).load(path).select("path"))
    return files.agg(F.countDistinct("path").alias("n")).first()["n"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))
