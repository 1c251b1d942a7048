"""Incremental compaction of the recommendation store (K-3, U-1, A-12, P-9).

The store gets files with every micro-batch and is never rewritten.  A
compacted generation is one Parquet row per user, the latest list with the
columns that decided it, and the table of the files folded into it:

    <root>/gen=<n>,block=<b>/lists/user_block=<k>/...   users k*b .. k*b+b-1, sorted
    <root>/gen=<n>,block=<b>/folded/...                 (path, file_time) of each file

``fold_new`` lists the store, takes only files no generation has folded, and
merges them: "latest" is a maximum, so merging equals reducing everything
again.  Work is one row per user and the new files, not the history.  The
files are remembered one by one, not by a time mark, since a file can become
visible after a newer one.  A generation counts once both its parts are
complete, ``folded`` last, so a job that dies leaves the one before in use.

``user_block`` is the index of point lookups (P-9): user ids are dense, so a
lookup knows its folder; the others aren't opened, and inside the folder the
sorted ids let Parquet skip all but one row group.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators import serve
from ratewise.session import remove_path
from ratewise.sources import store

USER_BLOCK = 1 << 20    # users per folder
KEPT_GENERATIONS = 2    # the last one may still be read when a new one is done
MAX_BLOCK_LIST = 1000   # folders named in a filter; a lookup of more reads the table
LIST_COLUMNS = ("user_idx", "recommendations", "batch_id", "run_id", "file_time", "file_path")


@dataclass(frozen=True)
class Generation:
    number: int
    block: int
    path: str

    @property
    def lists(self) -> str:
        return f"{self.path}/lists"

    @property
    def folded(self) -> str:
        return f"{self.path}/folded"


def generations(spark: SparkSession, root: str) -> list[Generation]:
    """The complete generations, oldest first (one folder listing)."""
    if not store.path_exists(spark, root):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(p):
        m = re.fullmatch(r"gen=(\d+),block=(\d+)", status.getPath().getName())
        if m:
            g = Generation(int(m[1]), int(m[2]), f"{root}/{m[0]}")
            if all(store.path_exists(spark, f"{part}/_SUCCESS") for part in (g.lists, g.folded)):
                found.append(g)
    return sorted(found, key=lambda g: g.number)


def listing(spark: SparkSession, store_dir: str, glob: str = "*.json") -> DataFrame:
    """``(path, file_time)`` of the store's files; no file is opened."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .load(store_dir).select("path", F.col("modificationTime").alias("file_time")))


def unfolded(spark: SparkSession, store_dir: str, last: Generation | None) -> DataFrame:
    files = listing(spark, store_dir)
    return files if last is None else files.join(spark.read.parquet(last.folded), ["path", "file_time"], "left_anti")


def _new_rows(spark: SparkSession, new: DataFrame) -> DataFrame | None:
    # names of the files since the last fold; Spark's own listing holds them on the driver too
    paths = [r.path for r in new.select("path").collect()]
    return store.read_store(spark, paths).select(*LIST_COLUMNS) if paths else None


def _latest(rows: DataFrame) -> DataFrame:
    """One row per user with all its columns, the last by ``STORE_ORDER``."""
    order = F.struct(*store.STORE_ORDER)
    return (rows.where(F.col("user_idx").isNotNull()).groupBy("user_idx")
            .agg(F.max_by(F.struct(*LIST_COLUMNS[1:]), order).alias("r")).select("user_idx", "r.*"))


def lists_table(spark: SparkSession, gen: Generation) -> DataFrame:
    return spark.read.parquet(gen.lists)


def fold_new(spark: SparkSession, store_dir: str, root: str, block: int = USER_BLOCK,
             keep: int = KEPT_GENERATIONS) -> Generation | None:
    """Fold the files that are new since the last generation into a new one;
    returns the current generation (None while the store has no file)."""
    done = generations(spark, root)
    last = done[-1] if done else None
    new = unfolded(spark, store_dir, last).cache()
    try:
        rows = _new_rows(spark, new)
        if rows is None:
            return last
        number = 1 + max((g.number for g in done), default=-1)
        gen = Generation(number, block, f"{root}/gen={number},block={block}")
        merged = _latest(rows)  # the new files are reduced before they meet the table
        if last is not None:
            merged = merged.unionByName(lists_table(spark, last).select(*LIST_COLUMNS))
        # one exchange by range serves the merge and the layout
        whole = _latest(merged.repartitionByRange("user_idx"))
        (whole.withColumn("user_block", F.floor(F.col("user_idx") / block).cast("int"))
              .sortWithinPartitions("user_block", "user_idx")
              .write.mode("overwrite").partitionBy("user_block").parquet(gen.lists))
        files = new.unionByName(spark.read.parquet(last.folded)) if last is not None else new
        files.write.mode("overwrite").parquet(gen.folded)
    finally:
        new.unpersist()
    for old in (done + [gen])[:-keep]:
        remove_path(spark, old.path)
    return gen


def current_lists(spark: SparkSession, store_dir: str, root: str) -> DataFrame:
    """A-12: the latest list per user, ``(user_idx, recommendations,
    batch_id)``: the last generation as it is, merged with files that aren't
    folded yet only if there are any."""
    done = generations(spark, root)
    last = done[-1] if done else None
    rows = _new_rows(spark, unfolded(spark, store_dir, last)) if store.path_exists(spark, store_dir) else None
    if last is None:
        rows = rows if rows is not None else spark.createDataFrame(
            [], "user_idx int, recommendations array<struct<product_idx: int, rating: float>>, batch_id long, "
                "run_id string, file_time timestamp, file_path string")
        return serve.latest_lists(rows, store.STORE_ORDER)
    table = lists_table(spark, last)
    if rows is None:
        return table.select("user_idx", "recommendations", "batch_id")
    return serve.latest_lists(table.select(*LIST_COLUMNS).unionByName(_latest(rows)), store.STORE_ORDER)


def point_lookup(spark: SparkSession, gen: Generation, user_idx: int) -> DataFrame:
    """P-9: one user's list; only its folder is listed and opened."""
    return lists_table(spark, gen).where((F.col("user_block") == user_idx // gen.block) & (F.col("user_idx") == user_idx))


def lookup_lists(spark: SparkSession, gen: Generation, requests: DataFrame, column: str = "user_id") -> DataFrame:
    """The lists of a generation, cut down to the folders of the requested users."""
    table = lists_table(spark, gen).select("user_idx", "recommendations", "batch_id", "user_block")
    block = F.floor(F.col(column) / gen.block).cast("int")
    blocks = [r.b for r in requests.select(block.alias("b")).where("b IS NOT NULL").distinct().limit(MAX_BLOCK_LIST + 1).collect()]
    if len(blocks) <= MAX_BLOCK_LIST:
        table = table.where(F.col("user_block").isin(blocks))
    return table.drop("user_block")
