"""Serving datasets over the recommendation store (V-1..V-7, A-9..A-12,
R-5..R-12).

The store is ``(user_idx, recommendations, batch_id)`` rows, appended once
per micro-batch.  Lookups run against the latest list per user, a
``max_by`` aggregate (partial per task, so a user present in many batches
is reduced before the shuffle).  Values gathered on the driver are bounded
constants only: the user total and the 10-id hint list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config
from ratewise.functions import scalars as S
from ratewise.operators.skew import split_hot_join


def latest_lists(store: DataFrame, order_cols: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """A-12: per user, the list that is last by the order columns (for a
    store: run start, then ``batch_id``) - "last one wins", made deterministic."""
    order = F.struct(*[F.col(c) for c in order_cols])
    return (store.where(F.col("user_idx").isNotNull())
                 .groupBy("user_idx")
                 .agg(F.max_by("recommendations", order).alias("recommendations"),
                      F.max_by("batch_id", order).alias("batch_id")))


def list_sizes(lists: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A-11: items per user (a missing list counts 0)."""
    return lists.select("user_idx", *keep, F.size(F.coalesce(
        F.col("recommendations"), F.array())).cast("int").alias("n_items"))


def user_total(lists: DataFrame) -> DataFrame:
    """A-9: users that have a list (exact distinct count)."""
    return lists.agg(F.countDistinct("user_idx").alias("total_users"))


def hint_ids(lists: DataFrame, size: int = config.HINT_SIZE) -> list[int]:
    """R-12: the first ``size`` available ids (a bounded TakeOrdered)."""
    return [r[0] for r in lists.select("user_idx").orderBy("user_idx").limit(size).collect()]


def _lists_for(requests: DataFrame, lists: DataFrame) -> tuple[DataFrame, int]:
    """The lists of the requested users only, as ``(user_id, recommendations)``,
    with the number of distinct requested ids (an upper bound on its rows).

    With a request set under the broadcast limit (counted), the store is
    semi-joined against the broadcast ids, so a handful of lookups never
    shuffles every user's list; otherwise the planner joins normally.
    """
    ids = requests.select("user_id").distinct()
    # no answer is longer than the bound of n, so a row's width is bounded
    side = lists.select(F.col("user_idx").alias("user_id"),
                        F.slice("recommendations", 1, config.SERVE_MAX_N).alias("recommendations"))
    n_ids = ids.count()
    if n_ids <= config.BROADCAST_MAX_ROWS:
        return side.join(F.broadcast(ids), "user_id", "left_semi"), n_ids
    return side, n_ids


def lookup(requests: DataFrame, lists: DataFrame) -> DataFrame:
    """V-2 for many users at once: ``requests(user_id, n)`` left-joined to
    the latest lists.

    Output per request: ``user_id, status ('ok' | 'unknown'), n_used,
    recommendations (labels), details (id, idx, score 4 dp), total``.
    ``n`` defaults to 5 and is clamped to 1..20 (F-8, F-9).
    """
    n_used = S.clamp(S.with_default(F.col("n"), config.SERVE_DEFAULT_N),
                     config.SERVE_MIN_N, config.SERVE_MAX_N)
    side, n_ids = _lists_for(requests, lists)
    # many requests for one user are joined in place, not shuffled together
    joined = split_hot_join(requests, side, "user_id", how="left",
                            side_rows=n_ids if n_ids <= config.BROADCAST_MAX_ROWS else None,
                            row_bytes=config.ID_ROW_BYTES + 32 * config.SERVE_MAX_N)
    recs = F.slice(F.col("recommendations"), 1, n_used)
    return joined.select(
        "user_id",
        F.when(F.col("recommendations").isNull(), F.lit("unknown")).otherwise(F.lit("ok"))
         .alias("status"),
        n_used.cast("int").alias("n_used"),
        S.item_labels(recs).alias("recommendations"),
        S.item_details(recs).alias("details"),
        # explicit null branch: size(null) is -1 when ANSI mode is off
        F.when(recs.isNull(), F.lit(0)).otherwise(F.size(recs)).cast("int").alias("total"),
    )


def lookup_items(requests: DataFrame, lists: DataFrame) -> DataFrame:
    """V-2 flattened: one row per returned item (R-6 position, 1-based)."""
    res = lookup(requests, lists).where(F.col("status") == "ok")
    return res.select("user_id", "total", F.posexplode("details").alias("pos", "d")).select(
        "user_id", (F.col("pos") + 1).cast("int").alias("pos"),
        F.col("d.product_id").alias("product_id"), F.col("d.product_idx").alias("product_idx"),
        F.col("d.score").alias("score"), "total")


def with_product_ids(items: DataFrame, products: DataFrame, n_products: int | None = None) -> DataFrame:
    """F-6 from the saved dictionary ``(ProductId, product_idx)``: adds the
    ``ProductId`` of each row's ``product_idx``, the label where the
    dictionary has none.  Popular products don't gather in one task."""
    named = products.select("product_idx", "ProductId")
    joined = split_hot_join(items, named, "product_idx", how="left", side_rows=n_products)
    return joined.withColumn("ProductId", F.coalesce("ProductId", S.product_label(F.col("product_idx"))))


def unknown_users(requests: DataFrame, lists: DataFrame) -> DataFrame:
    """R-12: requests with no list, each with the hint of available ids and
    the number of users with lists, plus the error and hint texts of the
    lookup response (the ids listed as quoted strings, as the reference
    printed them)."""
    hint = hint_ids(lists)
    if not hint:  # an empty store has an answer of its own, without hints
        return requests.select("user_id").distinct().select(
            "user_id", F.lit("unknown").alias("status"), F.lit("").alias("hint"), F.lit(0).cast("long").alias("total_users"),
            F.lit(config.EMPTY_STORE_ERROR).alias("error"), F.lit(None).cast("string").alias("hint_text"))
    total = lists.count()  # one number; the store itself stays distributed
    known = _lists_for(requests, lists)[0].select("user_id")
    unknown = requests.select("user_id").distinct().join(known, "user_id", "left_anti")
    quoted = "[" + ", ".join(f"'{h}'" for h in hint) + "]"
    err_head, err_tail = config.UNKNOWN_USER_ERROR.split("{user_id}")
    return unknown.select(
        "user_id",
        F.lit("unknown").alias("status"),
        F.lit(", ".join(str(h) for h in hint)).alias("hint"),
        F.lit(total).cast("long").alias("total_users"),
        F.concat(F.lit(err_head), F.col("user_id").cast("string"), F.lit(err_tail)).alias("error"),
        F.lit(config.UNKNOWN_USER_HINT.format(ids=quoted)).alias("hint_text"))


def overview(lists: DataFrame, limit: int | None = config.OVERVIEW_DEFAULT_LIMIT) -> DataFrame:
    """V-3 / R-9: the first ``limit`` users (by id; negative -> 0) with the
    labels of their first 5 items and the number of all users with lists."""
    lim = max(config.OVERVIEW_DEFAULT_LIMIT if limit is None else limit, 0)
    first = lists.orderBy("user_idx").limit(lim)
    return first.select("user_idx", S.item_labels(
        F.slice("recommendations", 1, config.OVERVIEW_ITEMS)).alias("top5"),
        F.lit(lists.count()).cast("long").alias("total_users"))


def user_directory(lists: DataFrame, cap: int = config.USER_LIST_CAP) -> DataFrame:
    """V-4 / R-8: ids ascending, first ``cap``, and the number of all ids."""
    return (lists.select("user_idx").orderBy("user_idx").limit(cap)
                 .withColumn("total", F.lit(lists.count()).cast("long")))


def random_user(lists: DataFrame, seed: int = config.SEED) -> DataFrame:
    """V-6 / R-11: one user chosen by a seeded hash order (reproducible);
    empty when there is no list."""
    key = F.md5(F.concat(F.col("user_idx").cast("string"), F.lit(f"|{seed}")))
    return lists.select("user_idx").orderBy(key, "user_idx").limit(1)


def display_rows(lists: DataFrame) -> DataFrame:
    """V-7: rank, label, score and bar percent of every list item.

    bar = round_half_up(score / (best score of the user * 1.2) * 100).
    """
    # the best score is taken within the list: no shuffle of its items
    best = F.array_max(F.transform("recommendations", lambda r: r["rating"].cast("double")))
    items = lists.select("user_idx", best.alias("best"), F.posexplode("recommendations").alias("pos", "r"))
    ratio = F.try_divide(F.col("r.rating").cast("double"), F.col("best") * F.lit(config.DISPLAY_BAR_SCALE))
    return items.select(
        "user_idx",
        (F.col("pos") + 1).cast("int").alias("rank"),
        S.product_label(F.col("r.product_idx")).alias("product_id"),
        S.round4(F.col("r.rating")).alias("score"),
        F.floor(ratio * 100 + F.lit(0.5)).cast("int").alias("bar_pct"))


def sample_sizes(lists: DataFrame, n: int = config.REPORT_SAMPLE_USERS) -> DataFrame:
    """R-10: the first ``n`` users with their list sizes (report sample)."""
    return list_sizes(lists.orderBy("user_idx").limit(n))


def compact_latest(store: DataFrame, path: str, order_cols: tuple[str, ...] = ("batch_id",),
                   files: int | None = None) -> None:
    """Batch job: the latest list per user written as one Parquet table, so
    serving reads one row per user instead of re-reducing every batch ever
    appended.  Rerunning it over the compacted table plus newer batches
    gives the same result (``max_by`` on the batch id is associative).

    Rows are range-partitioned and sorted by ``user_idx``: each file and row
    group covers a narrow id range, so a point lookup (P-9) is pruned by the
    Parquet min/max statistics to one row group.
    """
    latest = latest_lists(store, order_cols)
    n = files or latest.sparkSession.sparkContext.defaultParallelism
    (latest.repartitionByRange(n, "user_idx").sortWithinPartitions("user_idx")
           .write.mode("overwrite").parquet(path))


def point_lookup(compacted: DataFrame, user_idx: int) -> DataFrame:
    """P-9: one user's list; the equality reaches the Parquet scan as a
    pushed filter."""
    return compacted.where(F.col("user_idx") == F.lit(user_idx))
