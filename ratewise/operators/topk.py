"""Top-k items per user by dot product of factor vectors (J-5, J-6, R-3, R-4).

User x item pairs are never rows.  Items in order of falling norm are
searched until a bound ends the search of a user, and blocks of items that
point elsewhere are skipped (``pruned``).

* Items up to ``BROADCAST_MAX_BYTES`` (their rows and width are counted first)
  go to every task once; users stay where they are, so there is no shuffle.
* More items: they are written once, by falling norm, as files of about
  ``block_rows`` rows in the shared scratch folder.  Users are shuffled once, by
  id, into groups of at most ``USERS_HELD``; a task reads the item files one
  after the other and stops as soon as no user of the group is going.  What is
  shuffled and written is one row per user and per item, whatever their
  product; a task holds one group with its lists and one item file.

The tie rule (lower item id first) holds on both ways.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config
from ratewise.functions.scalars import dot
from ratewise.operators.pruned import FIRST_BAND, LARGEST_BAND, ItemIndex, RunningSearch
from ratewise.operators.skew import split_hot_join
from ratewise.session import open_folder, remove_path, scratch_dir

_CAND_SCHEMA = "_u long, _i long, _s double, _r int"
_LIST = pa.list_(pa.struct([("item", pa.int32()), ("rating", pa.float32())]))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def broadcast_items(items: DataFrame, *, item_col: str = "id", vec_col: str = "features", n_items: int | None = None,
                    max_bytes: int | None = None) -> Broadcast | None:
    """The item index for every task, or None if the items, counted with their
    vectors, exceed ``max_bytes`` (``BROADCAST_MAX_BYTES``)."""
    rows, width = factor_bytes(items, vec_col, n_items)
    if rows * width > (config.BROADCAST_MAX_BYTES if max_bytes is None else max_bytes):
        return None
    table = items.select(F.col(item_col).cast("long").alias("i"), F.col(vec_col).alias("v")).toArrow().combine_chunks()
    ids = table.column("i").to_numpy()
    vectors = _matrix(table.column("v").combine_chunks()) if len(ids) else np.zeros((0, 0))
    return items.sparkSession.sparkContext.broadcast(ItemIndex(ids, vectors))


def _found(users: pa.Array, ids: np.ndarray, scores: np.ndarray, lists: bool) -> pa.RecordBatch:
    """The lists of ``users`` as candidate rows, or one row per user."""
    n, kk = ids.shape
    if lists:
        items = pa.StructArray.from_arrays([pa.array(ids.ravel().astype(np.int32)),
                                            pa.array(scores.ravel().astype(np.float32))], fields=list(_LIST.value_type))
        offsets = pa.array(np.arange(0, n * kk + 1, kk, dtype=np.int32))
        return pa.record_batch([users, pa.ListArray.from_arrays(offsets, items)], names=["_u", "_l"])
    return pa.record_batch([pa.array(np.repeat(users.to_numpy(), kk)), pa.array(ids.ravel()),
                            pa.array(scores.ravel()), pa.array(np.tile(np.arange(1, kk + 1, dtype=np.int32), n))],
                           names=["_u", "_i", "_s", "_r"])


def _source(users: DataFrame, user_col: str, vec_col: str) -> DataFrame:
    return users.select(F.col(user_col).cast("long").alias("_u"), F.col(vec_col).alias("_v"))


def _result_schema(lists: bool) -> str:
    return "_u long, _l array<struct<item: int, rating: float>>" if lists else _CAND_SCHEMA


def _searched(users: DataFrame, index: Broadcast, k: int, user_col: str, vec_col: str, lists: bool) -> DataFrame:
    """Candidate rows (``_CAND_SCHEMA``), or one list per user; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, scores = index.value.search(_matrix(batch.column("_v")), k)
            if ids.shape[1]:
                yield _found(batch.column("_u"), ids, scores, lists)
    return _source(users, user_col, vec_col).mapInArrow(run, _result_schema(lists))


@dataclass
class ItemFiles:
    """Items in files by falling norm, in the shared scratch folder."""

    folder: str
    files: list[tuple[str, float]]  # name and largest norm, the largest first
    n_items: int

    def table(self, spark) -> DataFrame:
        return spark.read.schema("_i long, _v array<float>").parquet(self.folder)


def write_items(items: DataFrame, n_items: int, block_rows: int, *, item_col: str = "id",
                vec_col: str = "features") -> ItemFiles:
    """Write the items once, sorted by norm through a range shuffle; the
    driver receives one name and norm per file."""
    spark = items.sparkSession
    folder = scratch_dir(spark, "items")
    v = F.col(vec_col)
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = items.select(F.col(item_col).cast("long").alias("_i"), v.alias("_v"), norm.alias("_n"))
    rows.repartitionByRange(_blocks(n_items, block_rows), F.col("_n").desc(), F.col("_i")).write.parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    tops = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(F.max("_n").alias("top"))
    # Spark's order: a norm that isn't a number counts as the largest
    files = [(r["name"], r["top"]) for r in tops.orderBy(F.col("top").desc(), "name").collect()]
    return ItemFiles(folder, files, n_items)


# Users a task searches for together: their vectors and lists are in its memory,
# and each group reads the item files it needs once.
USERS_HELD = 131_072


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches put together to ``USERS_HELD`` rows, or one batch more."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= USERS_HELD:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched_files(users: DataFrame, items: ItemFiles, k: int, user_col: str, vec_col: str, lists: bool,
                    n_users: int | None) -> DataFrame:
    """As ``_searched``, against items in files; users are shuffled once so
    that tasks have groups of about the same size."""
    folder, files, kk = items.folder, items.files, min(k, items.n_items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kk:
            return
        fs, base = open_folder(folder)
        for group in _groups(batches):
            search = RunningSearch(_matrix(group.column("_v").combine_chunks()), kk)
            for n, (name, top) in enumerate(files):
                going = search.going(top)
                if not going:
                    break
                part = pq.ParquetFile(fs.open_input_file(f"{base}/{name}")).read(["_i", "_v"]).combine_chunks()
                search.add(ItemIndex(part.column("_i").to_numpy(), _matrix(part.column("_v").combine_chunks()),
                                     first_band=LARGEST_BAND if n else FIRST_BAND, split=going >= SPLIT_USERS))
            owners = group.column("_u").combine_chunks()
            for a in range(0, len(owners), ROWS_OUT):
                yield _found(owners.slice(a, ROWS_OUT), search.ids[a:a + ROWS_OUT], search.scores[a:a + ROWS_OUT], lists)
    if n_users is None:
        n_users = users.count()
    source = _source(users, user_col, vec_col)
    tasks = _user_blocks(n_users, USERS_HELD, users.sparkSession.sparkContext.defaultParallelism)
    return source.repartition(tasks, "_u").mapInArrow(run, _result_schema(lists))


ROWS_OUT = 4096  # users per batch of results
SPLIT_USERS = 4096  # users for whom the items of a file are put together by direction


def _rows(cand: DataFrame, user_out: str, item_out: str) -> DataFrame:
    return cand.select(F.col("_u").alias(user_out), F.col("_r").alias("rank"),
                       F.col("_i").alias(item_out), F.col("_s").alias("score"))


def _blocks(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / block_rows))


_MIN_USER_BLOCK = 256


def _user_blocks(n_users: int, block_rows: int, parallelism: int) -> int:
    """At most ``block_rows`` users per block, and at least one block per
    core while blocks keep ``_MIN_USER_BLOCK`` users (so a mid-size input
    is not scored by a single task)."""
    return max(_blocks(n_users, block_rows),
               min(parallelism, max(1, n_users // _MIN_USER_BLOCK)))


def top_k_by_dot(users: DataFrame, items: DataFrame, k: int = config.TOP_K, *,
                 user_col: str = "id", item_col: str = "id", vec_col: str = "features",
                 user_out: str = "user", item_out: str = "item",
                 block_rows: int = config.TOPK_BLOCK_ROWS,
                 n_users: int | None = None, n_items: int | None = None,
                 broadcast_bytes: int | None = None) -> DataFrame:
    """``(user_out long, rank int, item_out long, score double)``: the k best
    items of every user, rank 1 = highest score, ties by lower item id."""
    index = broadcast_items(items, item_col=item_col, vec_col=vec_col, n_items=n_items, max_bytes=broadcast_bytes)
    if index is not None:
        return _rows(_searched(users, index, k, user_col, vec_col, False), user_out, item_out)
    files = write_items(items, items.count() if n_items is None else n_items, block_rows, item_col=item_col, vec_col=vec_col)
    return _rows(_searched_files(users, files, k, user_col, vec_col, False, n_users), user_out, item_out)


def top_lists_by_dot(users: DataFrame, items: DataFrame, k: int = config.TOP_K, *,
                     user_out: str = "user_idx", item_out: str = "product_idx", user_col: str = "id",
                     vec_col: str = "features", n_users: int | None = None, n_items: int | None = None,
                     broadcast_bytes: int | None = None) -> DataFrame:
    """``as_lists(top_k_by_dot(...))`` for distinct users; each list is made
    where its user is searched for, with broadcast items without a shuffle."""
    index = broadcast_items(items, vec_col=vec_col, n_items=n_items, max_bytes=broadcast_bytes)
    if index is None:
        files = write_items(items, items.count() if n_items is None else n_items, config.TOPK_BLOCK_ROWS, vec_col=vec_col)
        return _lists(_searched_files(users, files, k, user_col, vec_col, True, n_users), user_out, item_out)
    return _lists(_searched(users, index, k, user_col, vec_col, True), user_out, item_out)


def _lists(found: DataFrame, user_out: str, item_out: str) -> DataFrame:
    return found.select(F.col("_u").cast("int").alias(user_out),
                        F.col("_l").cast(f"array<struct<{item_out}: int, rating: float>>").alias("recommendations"))


@dataclass
class PreparedItems:
    """Items made ready once for a scorer that runs again and again (one call
    per micro-batch): the broadcast index, or beyond the byte limit the item
    files, so that a call then shuffles only its users, never the catalogue."""

    table: DataFrame | None  # (_i, _v) of the files
    n_items: int
    nb_i: int
    block_rows: int
    index: Broadcast | None = None
    files: ItemFiles | None = None

    def release(self) -> None:
        if self.files is not None:
            remove_path(self.table.sparkSession, self.files.folder)
        if self.index is not None:
            self.index.unpersist()


def prepare_items(items: DataFrame, *, item_col: str = "id", vec_col: str = "features",
                  block_rows: int = config.TOPK_BLOCK_ROWS,
                  partitions: int | None = None, broadcast_bytes: int | None = None) -> PreparedItems:
    """``partitions``: files at least, while they keep ``_MIN_USER_BLOCK`` items."""
    n_items = items.count()
    index = broadcast_items(items, item_col=item_col, vec_col=vec_col, n_items=n_items, max_bytes=broadcast_bytes)
    if index is not None:
        return PreparedItems(table=None, n_items=n_items, nb_i=1, block_rows=block_rows, index=index)
    rows = min(block_rows, max(_MIN_USER_BLOCK, math.ceil(n_items / (partitions or 1))))
    files = write_items(items, n_items, rows, item_col=item_col, vec_col=vec_col)
    return PreparedItems(table=files.table(items.sparkSession), n_items=n_items, nb_i=len(files.files),
                         block_rows=block_rows, files=files)


def top_k_prepared(users: DataFrame, prepared: PreparedItems, k: int = config.TOP_K, *,
                   user_col: str = "id", vec_col: str = "features",
                   user_out: str = "user", item_out: str = "item",
                   n_users: int | None = None) -> DataFrame:
    """As ``top_k_by_dot`` against prepared items."""
    if prepared.index is not None:
        return _rows(_searched(users, prepared.index, k, user_col, vec_col, False), user_out, item_out)
    if prepared.files is None:  # a bare table
        items = prepared.table.select(F.col("_i").alias("id"), F.col("_v").alias("features"))
        return top_k_by_dot(users, items, k, user_col=user_col, vec_col=vec_col,
                            user_out=user_out, item_out=item_out, block_rows=prepared.block_rows,
                            n_users=n_users, n_items=prepared.n_items, broadcast_bytes=-1)
    return _rows(_searched_files(users, prepared.files, k, user_col, vec_col, False, n_users), user_out, item_out)


def lists_prepared(users: DataFrame, prepared: PreparedItems, k: int = config.TOP_K, *, user_out: str = "user_idx",
                   item_out: str = "product_idx", n_users: int | None = None) -> DataFrame:
    """``top_lists_by_dot`` against prepared items."""
    if prepared.index is not None:
        return _lists(_searched(users, prepared.index, k, "id", "features", True), user_out, item_out)
    if prepared.files is not None:
        return _lists(_searched_files(users, prepared.files, k, "id", "features", True, n_users), user_out, item_out)
    return as_lists(top_k_prepared(users, prepared, k, user_out=user_out, item_out=item_out, n_users=n_users),
                    user_out, item_out)


def as_lists(top: DataFrame, user: str = "user_idx", item: str = "product_idx") -> DataFrame:
    """Flat top-k rows -> ``(user, recommendations array<struct<item, rating
    float>>)`` ordered by rank (k elements per user, bounded)."""
    lists = (top.groupBy(user)
                .agg(F.sort_array(F.collect_list(F.struct(
                    F.col("rank"), F.col(item).cast("int").alias(item),
                    F.col("score").cast("float").alias("rating")))).alias("_l")))
    return lists.select(
        F.col(user).cast("int").alias(user),
        F.transform("_l", lambda e: F.struct(e[item].alias(item), e["rating"].alias("rating")))
         .alias("recommendations"))


def subset_factors(factors: DataFrame, requested: DataFrame, key: str = "id",
                   requested_key: str = "user_idx", requested_rows: int | None = None) -> DataFrame:
    """J-5: factor rows of the requested ids; duplicates collapse, ids absent
    from the model give no row.  The request side is broadcast only under
    the size limit (its row count is known or counted)."""
    req = requested.select(F.col(requested_key).alias(key)).distinct()
    if requested_rows is None:
        requested_rows = req.count()
    if requested_rows <= config.BROADCAST_MAX_ROWS:
        req = F.broadcast(req)
    return factors.join(req, on=key, how="left_semi")


def factor_bytes(factors: DataFrame, vec: str, rows: int | None = None) -> tuple[int, int]:
    """Rows of a factor table (counted unless known) and bytes of its widest row."""
    got = factors.agg(*([F.count(F.lit(1)).alias("n")] if rows is None else []),
                      F.coalesce(F.max(F.size(vec)), F.lit(0)).alias("width")).first()
    return (got["n"] if rows is None else rows), config.ID_ROW_BYTES + 8 * max(got["width"], 0)


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, *,
                user_col: str = "user_idx", item_col: str = "product_idx",
                vec_col: str = "features", out: str = "prediction",
                n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """J-4 / F-15: score given (user, item) pairs by the dot product of
    their factors (two equi-joins + a JVM ``aggregate(zip_with)``); pairs
    whose user or item has no factor are dropped (cold start ``drop``).

    Each factor table is broadcast when its rows, measured with their
    vectors, allow; otherwise the join salts hot users / popular items so
    their pairs are never shuffled into one task.  The pairs are never
    replicated."""
    u = users.select(F.col("id").alias(user_col), F.col(vec_col).alias("_uv"))
    i = items.select(F.col("id").alias(item_col), F.col(vec_col).alias("_iv"))
    n_users, u_bytes = factor_bytes(u, "_uv", n_users)
    n_items, i_bytes = factor_bytes(i, "_iv", n_items)
    scored = split_hot_join(split_hot_join(pairs, u, user_col, side_rows=n_users, row_bytes=u_bytes),
                            i, item_col, side_rows=n_items, row_bytes=i_bytes)
    return scored.withColumn(out, dot("_uv", "_iv")).drop("_uv", "_iv")
