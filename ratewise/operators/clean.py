"""Cleaning operators: null removal, deduplication, activity thresholds.

Shuffle plan of the chain (dedup -> user filter -> product filter):
every aggregate is partial + final (map-side combine), so one hot user or
product never ships its raw rows to a single task before being reduced;
the semi joins salt their hot keys (``skew.salted_join``) so a key with a
third of the rows is spread over many tasks.  The data is deliberately
*not* pre-partitioned by user alone: that would put a hot user's whole raw
history in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config
from ratewise.operators.skew import salted_join

KEYS = ("UserId", "ProductId")


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P-5 / P-6: drop rows with a null (or NaN) in ``subset`` (all columns
    by default)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P-7: conjunction of ``IS NOT NULL`` (pushed to the scan as IsNotNull)."""
    cond = None
    for c in columns:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df.where(cond)


def dedup_latest(df: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "Time",
                 score_col: str = "Score") -> DataFrame:
    """A-5: one row per (user, product): the latest ``Time`` wins, then the
    higher ``Score``.  Deterministic, unlike ``dropDuplicates``.

    ``max_by`` is a declarative aggregate, so Spark combines map-side before
    the shuffle on the key pair.
    """
    return (df.groupBy(*keys)
              .agg(F.max_by(F.col(score_col), F.struct(F.col(time_col), F.col(score_col)))
                    .alias(score_col),
                   F.max(time_col).alias(time_col)))


def _non_null():
    """The row test of ``drop_nulls`` on the three rating columns."""
    return (F.col("UserId").isNotNull() & F.col("ProductId").isNotNull()
            & F.col("Score").isNotNull() & ~F.isnan(F.col("Score")))


def dedup_counted(reviews: DataFrame) -> DataFrame:
    """A-5 with the counts of A-1: ``dedup_latest`` of the complete rows plus
    ``n_rows``, the reviews each row stands for, and one more row (null keys)
    for the incomplete ones, so one pass over the reviews gives the raw, the
    complete and the deduplicated rows.

    The counts are data, reduced with the rows before the shuffle.  Observed
    metrics would be accumulators: a map task run again after an executor
    loss adds to them twice.  The latest (Time, Score) is one buffer, so a
    shuffled row holds both once (``max_by`` and ``max`` hold them twice).
    """
    whole = _non_null()
    kept = reviews.select(*(F.when(whole, F.col(c)).alias(c) for c in (*KEYS, "Score", "Time")))
    return (kept.groupBy(*KEYS)
                .agg(F.max(F.struct("Time", "Score")).alias("_last"), F.count(F.lit(1)).alias("n_rows"))
                .select(*KEYS, "_last.Score", "_last.Time", "n_rows"))


def deduplicated(counted: DataFrame) -> DataFrame:
    """The reviews of ``dedup_counted``."""
    return counted.where(F.col("UserId").isNotNull()).select(*KEYS, "Score", "Time")


def counts_by(df: DataFrame, key: str, name: str = "nb_avis") -> DataFrame:
    """A-2 / A-3: reviews per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def active_keys(df: DataFrame, key: str, minimum: int) -> DataFrame:
    """P-8: keys with at least ``minimum`` rows."""
    return counts_by(df, key).where(F.col("nb_avis") >= minimum).select(key)


def keep_active(df: DataFrame, key: str, minimum: int,
                hot_rows: int = config.HOT_KEY_ROWS) -> DataFrame:
    """J-1 / J-2: keep rows whose key has at least ``minimum`` rows.

    The reference's inner join on a unique key is a left-semi join: no
    column is added and no row is duplicated.

    A key with ``hot_rows`` rows or more is hot: its rows are salted over
    many shuffle partitions (``skew.salted_join``) instead of all landing in
    one task; the hot-key set is bounded (at most total rows /
    ``hot_rows`` keys).  AQE's skew split cannot do this here: one join
    input is an aggregate, not a plain shuffle.
    """
    counts = counts_by(df, key)
    hot = counts.where(F.col("nb_avis") >= max(hot_rows, minimum)).select(key)
    active = counts.where(F.col("nb_avis") >= minimum).select(key)
    return salted_join(df, active, key, "left_semi", hot)


def clean_reviews(reviews: DataFrame,
                  min_user: int = config.MIN_REVIEWS_PER_USER,
                  min_product: int = config.MIN_REVIEWS_PER_PRODUCT,
                  hot_rows: int = config.HOT_KEY_ROWS) -> dict[str, DataFrame]:
    """The cleaning chain as named stages (lazy DataFrames).

    Order is fixed: users are filtered first, then products, once (users
    may drop below the threshold afterwards, as in the reference).
    """
    non_null = drop_nulls(reviews, ["UserId", "ProductId", "Score"])
    dedup = dedup_latest(non_null)
    return {"raw": reviews, "non_null": non_null, "dedup": dedup,
            **active_reviews(dedup, min_user, min_product, hot_rows)}


def active_users(dedup: DataFrame, min_user: int = config.MIN_REVIEWS_PER_USER,
                 hot_rows: int = config.HOT_KEY_ROWS) -> DataFrame:
    """J-1 over deduplicated reviews."""
    return keep_active(dedup, "UserId", min_user, hot_rows)


def active_products(users: DataFrame, min_product: int = config.MIN_REVIEWS_PER_PRODUCT,
                    hot_rows: int = config.HOT_KEY_ROWS) -> DataFrame:
    """J-2 over the reviews of active users."""
    return keep_active(users, "ProductId", min_product, hot_rows)


def active_reviews(dedup: DataFrame, min_user: int = config.MIN_REVIEWS_PER_USER,
                   min_product: int = config.MIN_REVIEWS_PER_PRODUCT,
                   hot_rows: int = config.HOT_KEY_ROWS) -> dict[str, DataFrame]:
    """The two activity filters over deduplicated reviews."""
    users = active_users(dedup, min_user, hot_rows)
    return {"active_users": users, "active_products": active_products(users, min_product, hot_rows)}


STAGES = ("raw", "non_null", "dedup", "active_users", "active_products", "final")



def _rows(agg: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One-row aggregate with a column per stage -> one row per stage."""
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(STAGES.index(n)).cast("int").alias("stage_no"), F.lit(n).alias("stage"),
                 F.coalesce(F.col(n), F.lit(0)).cast("long").alias("n_rows"))
        for n in names])))


def funnel(stages: dict[str, DataFrame], min_user: int = config.MIN_REVIEWS_PER_USER) -> DataFrame:
    """A-1: ``(stage_no, stage, n_rows)`` for the cleaning stages.

    Counted in as few passes as the stages allow: raw and non-null rows from
    the counts kept by ``dedup_counted`` (stage ``counted``), else in one
    aggregate over the raw input; deduplicated rows and rows of active
    users in one aggregate over the per-user review counts (the table the
    user filter is built from); the later stages from their own (usually
    written) frames.
    """
    if "counted" in stages:
        raw = stages["counted"].agg(F.sum("n_rows").alias("raw"),
                                    F.sum(F.when(F.col("UserId").isNotNull(), F.col("n_rows"))).alias("non_null"))
    else:
        raw = stages["raw"].agg(F.count(F.lit(1)).alias("raw"),
                                F.count_if(_non_null()).alias("non_null"))
    per_user = counts_by(stages["dedup"], "UserId")
    users = per_user.agg(
        F.sum("nb_avis").alias("dedup"),
        F.sum(F.when(F.col("nb_avis") >= min_user, F.col("nb_avis"))).alias("active_users"))
    out = _rows(raw, ("raw", "non_null")).unionByName(_rows(users, ("dedup", "active_users")))
    for name in ("active_products", "final"):
        if name in stages:
            out = out.unionByName(_rows(stages[name].agg(F.count(F.lit(1)).alias(name)), (name,)))
    return out
