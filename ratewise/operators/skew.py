"""Joins that stay balanced when one key holds a large share of the rows.

``df`` (many rows per key) joins ``side`` (one row per key).  If ``side`` is
small enough it is simply broadcast.  Otherwise the join is salted for hot
keys only:

* hot keys - keys with at least ``hot_rows`` rows in ``df``, found by a
  partial + final count, so at most rows / ``hot_rows`` of them - are
  broadcast as a flag table;
* each row of a hot key gets a salt ``xxhash64(row, input partition) mod S``
  (deterministic, so a recomputed task produces the same salt); other rows
  get salt 0;
* the ``side`` rows of hot keys are replicated once per salt, the rest once;
* the join runs on ``(key, salt)``: a hot key's rows spread over ``S``
  partitions, everything else joins exactly as before.

``df`` is read once; the only extra work is a map-side hash probe and a
bounded replication of ``side``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewise import config


def hot_keys(df: DataFrame, key: str, hot_rows: int = config.HOT_KEY_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows (bounded by rows / hot_rows)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= hot_rows).select(key))


def salt_buckets(df: DataFrame) -> int:
    """Salts per hot key: the shuffle width, within [2, 1024]."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, min(parts, 1024))


def salted_join(df: DataFrame, side: DataFrame, key: str, how: str, hot: DataFrame,
                buckets: int | None = None) -> DataFrame:
    """``df.join(side, key, how)`` (inner / left / left_semi) with the rows
    of the ``hot`` keys (a bounded key table) spread over ``buckets``
    partitions."""
    s = buckets or salt_buckets(df)
    flag = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    # the salt hashes the row's content (map columns cannot be hashed) and its
    # input partition, so equal rows spread too; both are the same in a rerun
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    row = F.xxhash64(*hashable, F.spark_partition_id())
    salted = (df.join(flag, on=key, how="left")
                .withColumn("_salt", F.when(F.col("_hot"), F.pmod(row, F.lit(s)))
                                      .otherwise(F.lit(0)))
                .drop("_hot"))
    side_salted = (side.join(flag, on=key, how="left")
                       .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(s - 1)))
                                                       .otherwise(F.array(F.lit(0)))))
                       .drop("_hot"))
    return salted.join(side_salted, on=[key, "_salt"], how=how).drop("_salt")


def fits_broadcast(rows: int, row_bytes: int = config.ID_ROW_BYTES) -> bool:
    """Whether ``rows`` rows of at most ``row_bytes`` are under both limits."""
    return rows <= config.BROADCAST_MAX_ROWS and rows * row_bytes <= config.BROADCAST_MAX_BYTES


def split_hot_join(df: DataFrame, side: DataFrame, key: str, how: str = "inner",
                   side_rows: int | None = None, row_bytes: int = config.ID_ROW_BYTES,
                   hot_rows: int = config.HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """``df.join(side, key, how)`` for ``how`` in inner / left, skew-safe.

    ``side_rows`` (the exact size of ``side``, when known) of ``row_bytes``
    each, below the broadcast limits, give a plain broadcast join.  ``hot``:
    the hot keys, where they are known without counting ``df``.
    """
    if side_rows is not None and fits_broadcast(side_rows, row_bytes):
        return df.join(F.broadcast(side), on=key, how=how)
    return salted_join(df, side, key, how, hot_keys(df, key, hot_rows) if hot is None else hot)
