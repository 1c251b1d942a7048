"""Centroid clustering on integers, in Spark's own expressions.

Vectors become arrays of integers once.  A round is one job without a
shuffle of vectors: ``aggregate(zip_with(...))`` gives the squared distance to
each literal centroid array, ``array_min`` over (distance, number) structs
chooses the nearest (ties: the smaller number), and one sum per component,
grouped by the choice, adds up partly before the shuffle, so a cluster of any
size sends one row per task.  The driver receives ``clusters`` rows a round;
centroids are literals of the next round's plan (``clusters`` x ``dims``
numbers, both parameters).  Means are exact: integer division rounding down.

Defined results: rows whose vector is null, has another number of components
or a null or non-finite one are left out; repeated rows are vectors of their
own; a null vec_id starts no centroid unless there are too few others; rows
with the same vec_id start in the order of their components; with fewer
vectors than ``clusters`` each is a start; no vectors, no rows; extra columns
are ignored.  Components so large that a squared distance doesn't fit 64 bits
raise ``ValueError`` (``largest_component``); a sum of distances beyond
64 bits stops the query with Spark's overflow error, never a wrong number.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import cut

DIMS = 64
CLUSTERS = 16
ROUNDS = 3
SCALE = 64
SCHEMA = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")


def integer_vectors(table: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors, ``v`` = floor(scale * component)."""
    usable = ((F.size("embedding") == dims)
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(usable).select("vec_id", v.alias("v"))


def largest_component(dims: int) -> int:
    """The magnitude up to which every squared distance fits a long."""
    return (math.isqrt(((1 << 63) - 1) // dims) - 1) // 2


def start_centroids(vectors: DataFrame, clusters: int) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids: a top-k, no sort of all."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.orderBy(name.asc_nulls_last(), "v").limit(clusters)
    return [list(r.v) for r in first.collect()]


def nearest(vector: str, centroids: list[list[int]]) -> Column:
    """struct(distance, cluster) of the centroid nearest to the column ``vector``."""
    def distance(c: list[int]) -> str:
        literal = "array(" + ",".join(f"{x}L" for x in c) + ")"
        return f"aggregate(zip_with({vector}, {literal}, (a, b) -> (a - b) * (a - b)), 0L, (total, x) -> total + x)"
    choices = (f"struct({distance(c)} AS distance, {k} AS cluster)" for k, c in enumerate(centroids))
    return F.expr(f"array_min(array({', '.join(choices)}))")


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: componentwise floor of the exact mean."""
    dims = range(len(centroids[0]))
    chosen = vectors.select(nearest("v", centroids)["cluster"].alias("cluster"), "v")
    wide = chosen.selectExpr("cluster", *(f"v[{i}] AS c{i}" for i in dims))
    sums = wide.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *(F.expr(f"sum(c{i}) AS c{i}") for i in dims))
    out = list(centroids)
    for r in sums.collect():  # one row per non-empty cluster
        out[r.cluster] = [r[f"c{i}"] // r.n for i in dims]
    return out


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def centroid_clusters(table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS,
                      scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256:
    one row per usable vector."""
    spark = table.sparkSession
    vectors = cut(integer_vectors(table, dims, scale), "vectors")
    top, low = vectors.agg(F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    if top is None:
        return spark.createDataFrame([], SCHEMA)
    if max(top, -low) > largest_component(dims):
        raise ValueError(f"a component beyond {largest_component(dims)} / {scale}: squared distances don't fit 64 bits")
    centroids = start_centroids(vectors, clusters)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    best = nearest("v", centroids)
    placed = cut(vectors.select("vec_id", best.alias("best")).select("vec_id", "best.cluster", "best.distance"), "placed")
    spent = {r.cluster: r.spent for r in placed.groupBy("cluster").agg(F.sum("distance").alias("spent")).collect()}
    inertia = sum(spent.values())
    if inertia >= 1 << 63:
        raise ValueError("the sum of all distances doesn't fit 64 bits")
    about = spark.createDataFrame([(k, spent[k], inertia, centroid_digest(centroids[k])) for k in sorted(spent)],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row per cluster
    return placed.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia",
                                                             "inertia", "centroid_sha256")
