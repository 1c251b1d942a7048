"""Review and message inputs derived from the driver's tables.

The reference reads a review CSV that is not shipped; the driver tables
stand in for it with a fixed mapping (see FIXTURES.md):

* reviews: every row of ``lineitem`` joined to ``orders``, with the line's
  flags in both keys: ``UserId = 'U' || o_custkey || '-' || flags``,
  ``ProductId = 'P' || l_partkey || '-' || flags`` (flags = l_returnflag ||
  l_linestatus), ``Score`` from a low-rank rule on the customer and part keys
  plus a small residue of the quantity, ``Time`` = epoch of ``l_shipdate``.
* stream messages: every row of ``events`` with ``UserId = 'U' || user_id ||
  '-' || flags`` (flags chosen by event_id), ``ProductId = 'P' || props.k ||
  '-' || flags``, ``Score = event_id % 5 + 1``, ``Time`` = epoch of ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.scalars import parse_json, to_json_text
from ratewise.sources.tables import read_table

# --- fixed values: the flag pairs of the line items -------------------------
FLAGS = ("AF", "AO", "NF", "NO", "RF", "RO")
# --- end of fixed values ---------------------------------------------------


def _key(prefix: str, number: Column, flags: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"), F.lit("-"), flags)


def _line_flags() -> Column:
    return F.concat("l_returnflag", "l_linestatus")


def _residue() -> Column:
    """1 on each fifth quantity."""
    return F.when(F.col("l_quantity").cast("int") % 5 == 0, F.lit(1)).otherwise(F.lit(0))


def _score(residue: Column) -> Column:
    """1 + (customer group) * (part group), plus 1 on each fifth quantity, 5 at
    most: a rank-2 signal that a factor model can learn."""
    signal = (F.col("o_custkey") % 3) * (F.col("l_partkey") % 3)
    return F.least(F.lit(5), F.lit(1) + signal + residue).cast("float")


def reviews(spark: SparkSession, base_dir: str) -> DataFrame:
    """``(UserId, ProductId, Score float, Time long)`` from lineitem ⋈ orders.

    Every line item is a review; only the columns of the mapping are read, and what the
    line alone gives (flags, residue) is made before the join, whose shuffled rows are
    narrower for it.  Orders is the
    smaller side but still grows with the data, so the join strategy is
    left to the planner (AQE turns it into a broadcast when it is small).
    """
    li = read_table(spark, base_dir, "lineitem", "l_orderkey", "l_partkey",
                    "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus").select(
        "l_orderkey", "l_partkey", "l_shipdate", _line_flags().alias("flags"), _residue().alias("residue"))
    orders = read_table(spark, base_dir, "orders", "o_orderkey", "o_custkey")
    joined = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    return joined.select(
        _key("U", F.col("o_custkey"), F.col("flags")).alias("UserId"),
        _key("P", F.col("l_partkey"), F.col("flags")).alias("ProductId"),
        _score(F.col("residue")).alias("Score"),
        F.unix_timestamp(F.col("l_shipdate")).alias("Time"),
    )


def event_messages(spark: SparkSession, base_dir: str) -> DataFrame:
    """Stream messages as JSON text, one per event: ``(event_id, ts, value)``.

    ``value`` is what a producer would publish (K-4 / F-2).
    """
    ev = read_table(spark, base_dir, "events", "event_id", "ts", "user_id", "props")
    k = parse_json("props", "k int").getField("k")
    flags = F.element_at(F.array(*[F.lit(x) for x in FLAGS]), (F.col("event_id") % len(FLAGS) + 1).cast("int"))
    msg = to_json_text(
        _key("U", F.col("user_id"), flags).alias("UserId"),
        _key("P", k, flags).alias("ProductId"),
        ((F.col("event_id") % 5) + 1).cast("float").alias("Score"),
        F.unix_timestamp(F.col("ts")).alias("Time"),
    )
    return ev.select("event_id", "ts", msg.alias("value"))


# --- fixed values: factor fixture -------------------------------------------
# each so many-th embedding is a user's factors (user id = vec_id / this), the
# others are items'; item ids named by the events are shifted by the second number
FACTOR_USER_EVERY = 20
FACTOR_ITEM_SHIFT = 50
# --- end of fixed values ---------------------------------------------------


def factor_fixture(spark: SparkSession, base_dir: str) -> tuple[DataFrame, DataFrame]:
    """``embeddings`` as given factors: ``(id int, features array<float>)``
    for users (each 20th row) and items (the rest)."""
    emb = read_table(spark, base_dir, "embeddings", "vec_id", "embedding")
    user = F.col("vec_id") % FACTOR_USER_EVERY == 0
    users = emb.where(user).select(F.expr(f"vec_id div {FACTOR_USER_EVERY}").cast("int").alias("id"),
                                   F.col("embedding").alias("features"))
    items = emb.where(~user).select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))
    return users, items


def reviews_with_gaps(spark: SparkSession, base_dir: str) -> DataFrame:
    """The review fixture with missing values planted by line number:
    ``UserId`` null on line 1, ``Score`` NaN on 2, ``ProductId`` null on 3,
    ``Score`` null on 4 (for the null-removal operators)."""
    li = read_table(spark, base_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus")
    orders = read_table(spark, base_dir, "orders", "o_orderkey", "o_custkey")
    j = li.join(orders, li["l_orderkey"] == orders["o_orderkey"], "inner")
    ln = F.col("l_linenumber")
    return j.select(
        F.when(ln != 1, _key("U", F.col("o_custkey"), _line_flags())).alias("UserId"),
        F.when(ln != 3, _key("P", F.col("l_partkey"), _line_flags())).alias("ProductId"),
        F.when(ln == 2, F.lit(float("nan")).cast("float"))
         .when(ln == 4, F.lit(None).cast("float")).otherwise(_score(_residue())).alias("Score"),
        F.unix_timestamp(F.col("l_shipdate")).alias("Time"),
    )


# --- fixed values: header of the review CSV (column order of the source file)
REVIEW_CSV_COLUMNS = ("Id", "ProductId", "UserId", "ProfileName", "HelpfulnessNumerator",
                      "HelpfulnessDenominator", "Score", "Time", "Summary", "Text")
# --- end of fixed values ---------------------------------------------------


def review_csv_rows(spark: SparkSession, base_dir: str) -> DataFrame:
    """The review fixture laid out as the review CSV, with free text that
    holds commas, doubled quotes and line breaks (derived from the row)."""
    r = reviews(spark, base_dir)
    text = F.concat(F.lit('Bought "'), F.col("ProductId"), F.lit('", twice.\nWould buy again, '),
                    F.col("UserId"))
    return r.select(
        F.monotonically_increasing_id().alias("Id"), "ProductId", "UserId",
        F.concat(F.lit("Name, of "), F.col("UserId")).alias("ProfileName"),
        F.lit(0).alias("HelpfulnessNumerator"), F.lit(0).alias("HelpfulnessDenominator"),
        F.col("Score").cast("int").alias("Score"), "Time",
        F.lit('"Good"').alias("Summary"), text.alias("Text"))
