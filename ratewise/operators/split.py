"""Reproducible train / validation / test split (M-1).

``randomSplit`` depends on the partition layout (the same seed gives other
rows after a repartition).  Here every row's split is a function of its key
pair only: the first 32 bits of ``md5(user|product)`` modulo 10 000 against
cumulative weight thresholds.  No shuffle, no sort, stable under any layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise import config

BUCKETS = 10_000
SPLIT_NAMES = ("train", "validation", "test")


def key_bucket(*keys: str, buckets: int = BUCKETS) -> Column:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return h % F.lit(buckets)


def thresholds(weights: Sequence[float], buckets: int = BUCKETS) -> list[int]:
    total = float(sum(weights))
    acc, out = 0.0, []
    for w in weights:
        acc += w
        out.append(int(round(acc / total * buckets)))
    return out


def assign_split(df: DataFrame, weights: Sequence[float] = config.SPLIT_WEIGHTS,
                 names: Sequence[str] = SPLIT_NAMES,
                 keys: Sequence[str] = ("user_idx", "product_idx")) -> DataFrame:
    """Add a ``split`` column."""
    b = key_bucket(*keys)
    cuts = thresholds(weights)
    expr = None
    for name, cut in zip(names, cuts):
        expr = F.when(b < cut, F.lit(name)) if expr is None else expr.when(b < cut, F.lit(name))
    return df.withColumn("split", expr)


def split_frames(df: DataFrame, **kw) -> dict[str, DataFrame]:
    """Three filtered views of one labelled frame (each a pushed filter)."""
    return labelled_frames(assign_split(df, **kw), kw.get("names", SPLIT_NAMES))


def labelled_frames(labelled: DataFrame, names: Sequence[str] = SPLIT_NAMES) -> dict[str, DataFrame]:
    """The views of a frame that has its ``split`` column."""
    return {n: labelled.where(F.col("split") == n).drop("split") for n in names}


def split_counts(df: DataFrame) -> DataFrame:
    return assign_split(df).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
