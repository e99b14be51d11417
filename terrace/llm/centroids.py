"""Integer k-means in JVM-native expressions.

Vectors become arrays of integers once (``quantize``).  A round is one aggregation without any shuffle of
vectors: ``zip_with`` and ``aggregate`` give the squared distance to each centroid, an array literal of the
plan; ``array_min`` of (distance, number) structs chooses the cluster, ties by the smaller number; and plain
``sum`` columns, one per component, go through whole-stage code and a partial aggregation.  What reaches the
driver is one row per cluster: the number of clusters times the number of components, whatever the size of
the table, and a cluster that holds every row costs nothing extra.

Arithmetic is exact: components are longs, sums are decimals, quotients are floored.  A distance that does not fit a long raises an
arithmetic error and never wraps (components below 2^27 in absolute value always fit).

Defined cases: vectors that are null, have another number of components or hold null or non-finite ones take no part;
a null id takes part but is never a seed; equal ids each take part, and may each be a seed (ties
of the seed hash go by the components); fewer rows than ``k`` give as many centroids as there are rows;
empty clusters keep their centroid; an empty table gives no rows; further columns of the input are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.session import materialize

OUT = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def quantize(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64,
             scale: int = 1024) -> DataFrame:
    """(vec_id, q): floor(scale * x) of each component, of the vectors that take part."""
    v = F.col(vec_col)

    def usable(x: Column) -> Column:
        d = x.cast("double")
        return d.isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf"))

    keep = (F.size(v) == dim) & F.forall(v, usable)
    return vectors.where(F.coalesce(keep, F.lit(False))).select(
        F.col(id_col).alias("vec_id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")).alias("q"))


def seeds(q: DataFrame, k: int = 8, salt: str = "3") -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``<salt>:<vec_id>``, in that order: a top-k, k rows to the driver."""
    ranked = q.where(F.col("vec_id").isNotNull()).withColumn(
        "_hash", F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
    return [list(r["q"]) for r in ranked.orderBy("_hash", "q").limit(k).collect()]


def _literal(centroid: list[int]) -> Column:
    """An array literal once constants are folded; one expression, where an ``array`` call has one a component."""
    return F.split(F.lit(",".join(str(int(c)) for c in centroid)), ",").cast("array<bigint>")


def squared_distance(q: Column, centroid: list[int]) -> Column:
    squares = F.zip_with(q, _literal(centroid), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda acc, x: acc + x)


def nearest(q: Column, centroids: list[list[int]]) -> Column:
    """Struct (distance, cluster) of the nearest centroid; the smaller number among equals."""
    return F.array_min(F.array(*[F.struct(squared_distance(q, c).alias("distance"), F.lit(i).alias("cluster"))
                                 for i, c in enumerate(centroids)]))


def assign(q: DataFrame, centroids: list[list[int]]) -> DataFrame:
    near = q.withColumn("_near", nearest(F.col("q"), centroids))
    return near.select("vec_id", "q", F.col("_near.cluster").alias("cluster"), F.col("_near.distance").alias("distance"))


def step(q: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: assign, then the floored mean of every cluster that is not empty."""
    dim = len(centroids[0])
    sums = [F.expr(f"sum(q[{i}]) AS s{i}") for i in range(dim)]
    rows = assign(q, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    new = [list(c) for c in centroids]
    for r in rows:
        new[r["cluster"]] = [int(r[f"s{i}"]) // int(r["n"]) for i in range(dim)]
    return new


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10,
            dim: int = 64, scale: int = 1024) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector, and the final centroids.

    The integer vectors are written once under spark.checkpoint.dir; every round reads them, so a lost executor
    costs its own tasks of one round.
    """
    q = materialize(quantize(vectors, id_col, vec_col, dim, scale), "centroids-vectors")
    centroids = seeds(q, k)
    if not centroids:
        empty = q.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in
                                     zip(OUT, ("int", "long", "long", "long", "string"))])
        return empty.where(F.lit(False)), []
    for _ in range(rounds):
        centroids = step(q, centroids)
    final = materialize(assign(q, centroids).drop("q"), "centroids-assigned")
    per = {r["cluster"]: int(r["d"]) for r in final.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    of_cluster = F.array(*[F.lit(per.get(i, 0)).cast("long") for i in range(len(centroids))])
    names = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    return final.select("vec_id", "cluster", "distance", of_cluster[F.col("cluster")].alias("cluster_inertia"),
                        F.lit(sum(per.values())).cast("long").alias("inertia"),
                        names[F.col("cluster")].alias("centroid_sha256")), centroids
