"""Is a factor model the solution it claims to be?  Residuals of the normal
equations (M-2, M-5).

The last half step of ALS solves, for every user u with n ratings r_i of
items with factors v_i,

    (sum v_i v_i^T + reg n I) u = sum r_i v_i

given the item factors the model holds.  The residual, left side less right
side, relative to the right side, is rounding for a correct fit and large for a
factor that was lost, mixed up or fitted on other ratings.

The matrix is never built: (sum v_i v_i^T) u = sum (v_i . u) v_i, so a rating
contributes its error times its item vector, ``rank`` sums per user that are
reduced before the shuffle.  Factor tables are broadcast when measured small,
else joined with hot keys salted; the user's own factors come last, so that a
user's ratings are in one task (a hot user's in a few) when they are summed, and
the shuffle of the sums has about one row per user.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.operators.skew import hot_keys, split_hot_join
from ratewise.operators.topk import factor_bytes

TOLERANCE = 1e-3  # factors are 32-bit floats


def normal_residuals(model: ALSModel, ratings: DataFrame, reg: float, side: str = "user") -> DataFrame:
    """``(<side>_idx, n_ratings, residual)`` per user (or per product, whose
    equations hold against the user factors of the half step before)."""
    own, other = ("user_idx", "product_idx") if side == "user" else ("product_idx", "user_idx")
    factors = {"user_idx": model.userFactors, "product_idx": model.itemFactors}
    rank = model.rank
    joined = ratings.select("user_idx", "product_idx", F.col("Score").cast("double").alias("r"))
    for key, name in ((other, "v"), (own, "u")):
        table = factors[key].select(F.col("id").alias(key), F.col("features").alias(name))
        rows, width = factor_bytes(table, name)
        # counted in the ratings, not in what the first join made of them
        joined = split_hot_join(joined, table, key, side_rows=rows, row_bytes=width, hot=hot_keys(ratings, key))
    u, v = ([F.col(name)[j].cast("double") for j in range(rank)] for name in ("u", "v"))
    error = sum((a * b for a, b in zip(u, v)), F.lit(0.0)) - F.col("r")
    sums = joined.select(own, "r", error.alias("e"), *(x.alias(f"v{j}") for j, x in enumerate(v)),
                         *(x.alias(f"u{j}") for j, x in enumerate(u))).groupBy(own).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        *(F.sum(F.col("e") * F.col(f"v{j}")).alias(f"g{j}") for j in range(rank)),
        *(F.sum(F.col("r") * F.col(f"v{j}")).alias(f"b{j}") for j in range(rank)),
        *(F.max(f"u{j}").alias(f"u{j}") for j in range(rank)))  # one value per group
    left = [F.col(f"g{j}") + F.lit(float(reg)) * F.col("n_ratings") * F.col(f"u{j}") for j in range(rank)]

    def norm(columns):
        return F.sqrt(sum((c * c for c in columns), F.lit(0.0)))
    right = norm([F.col(f"b{j}") for j in range(rank)])
    return sums.select(own, "n_ratings", (norm(left) / F.greatest(right, F.lit(1e-12))).alias("residual"))


def fit_report(model: ALSModel, train: DataFrame, reg: float, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per model: users, the largest residual and users beyond ``tolerance``."""
    return normal_residuals(model, train, reg).agg(
        F.count(F.lit(1)).alias("n_users"), F.max("residual").alias("largest"),
        F.count_if(F.col("residual") > tolerance).alias("n_beyond"))
