"""Dense integer ids by descending frequency (R-1, R-2).

Same result as MLlib ``StringIndexer`` (``frequencyDesc``, ties by label),
but distributed: ``StringIndexer.fit`` collects every label to the driver,
which does not hold for hundreds of millions of users.

Plan: count per label (partial + final aggregate) -> global sort by
(count desc, label) (range-partitioned, no single-partition window) ->
tag every row with its partition id and position inside the partition ->
reliable checkpoint so the layout is fixed even if a task is rerun ->
per-partition row counts (one row per partition, the only thing collected)
give each partition its starting offset -> id = offset + position.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise import config
from ratewise.operators.skew import salted_join
from ratewise.session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id = partition id << 33 | position
_LITERAL_OFFSETS_MAX = 1024  # beyond this many partitions, offsets are a broadcast table


@dataclass
class Dictionary:
    """A label -> dense id table with its exact size."""

    table: DataFrame  # (label_col, index_col)
    size: int
    label_col: str
    index_col: str
    # labels with at least HOT_KEY_ROWS rows when the dictionary was built
    # (a bounded set), or None when the frequencies are not known
    hot: DataFrame | None = None

    def attach(self, df: DataFrame, how: str = "inner") -> DataFrame:
        """Join the id onto ``df`` by label (``inner`` or ``left``).

        Below the size limit the whole dictionary is broadcast.  Above it,
        the sort-merge join is salted for the hot labels (known from the
        build), so no task receives all of a hot label's rows.
        """
        if self.size <= config.BROADCAST_MAX_ROWS:
            return df.join(F.broadcast(self.table), on=self.label_col, how=how)
        if self.hot is None:
            return df.join(self.table, on=self.label_col, how=how)
        return salted_join(df, self.table, self.label_col, how, self.hot.select(self.label_col))


def frequency_index(df: DataFrame, label_col: str, index_col: str,
                    hot_rows: int = config.HOT_KEY_ROWS) -> Dictionary:
    """Build the dictionary of ``label_col`` over the rows of ``df``."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    ordered = counts.orderBy(F.col("_n").desc(), F.col(label_col).asc())
    tagged = ordered.select(
        label_col, "_n",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    tagged = cut_lineage(tagged)
    # one row per partition: bounded by the partition count, not the data
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c")).collect()
    sizes = {r["_pid"]: r["_c"] for r in per_part}
    n_parts = max(sizes) + 1 if sizes else 0
    starts = [0] + list(accumulate(sizes.get(p, 0) for p in range(n_parts)))[:-1]
    total = sum(sizes.values())
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    if n_parts <= _LITERAL_OFFSETS_MAX:
        # partition start offsets as a literal array: a JVM expression, no join
        offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in starts]
                                      or [F.lit(0).cast("long")]), F.col("_pid") + 1)
        ided = tagged.select(label_col, "_n", (offset + pos).cast("int").alias(index_col))
    else:
        # many partitions: a broadcast table with one row per partition
        offsets = df.sparkSession.createDataFrame(list(enumerate(starts)), "_pid int, _off long")
        ided = (tagged.join(F.broadcast(offsets), "_pid")
                      .select(label_col, "_n", (F.col("_off") + pos).cast("int").alias(index_col)))
    table = ided.select(label_col, index_col)
    hot = ided.where(F.col("_n") >= hot_rows).select(label_col, index_col)
    return Dictionary(table=table, size=total, label_col=label_col, index_col=index_col, hot=hot)


def build_dictionaries(df: DataFrame, hot_rows: int = config.HOT_KEY_ROWS
                       ) -> tuple[Dictionary, Dictionary]:
    """R-1 and R-2: the user and product dictionaries, built as two
    concurrent jobs over the same (checkpointed) input."""
    with ThreadPoolExecutor(2) as pool:
        fu = pool.submit(frequency_index, df, "UserId", "user_idx", hot_rows)
        fp = pool.submit(frequency_index, df, "ProductId", "product_idx", hot_rows)
        return fu.result(), fp.result()


def encode_ratings(df: DataFrame, hot_rows: int = config.HOT_KEY_ROWS
                   ) -> tuple[DataFrame, Dictionary, Dictionary]:
    """R-1 + R-2 + casts: ``(user_idx int, product_idx int, Score float)``
    plus both dictionaries (the product one is saved too, unlike the
    reference, so ids can be mapped back)."""
    users, products = build_dictionaries(df, hot_rows)
    out = products.attach(users.attach(df))
    out = out.select("user_idx", "product_idx", F.col("Score").cast("float").alias("Score"))
    return out, users, products
