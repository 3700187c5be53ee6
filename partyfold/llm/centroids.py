"""Centroid clustering with an equal-average equal-variance search.

Components become integers `floor(factor * x)`. The first centroids are the vectors with the smallest
SHA-256 of `<seed>:<id>` in that order. Every round assigns all vectors to their nearest centroid and
replaces each centroid that has vectors by the floor of their mean; then they are assigned once more.
The search (`codebooks`) walks the centroids outward from the vector's mean and rejects by mean and deviation.

Only vectors with exactly `dims` components, none null or not finite, take part; the others have no
row. Components beyond 2**30 / dims are set to that bound, so that everything is exact in 64 bits; a sum of
distances beyond the range of a bigint is set to its end. Repeated rows and ids are vectors one by
one; a vector without an id is assigned but is a first centroid only if there are too few others. With
fewer vectors than centroids each is a centroid. An empty table gives an empty result. Other columns are ignored.

The driver sees the centroids and a sum for each; their number is a parameter and does not grow with the data.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.codebooks import assigned, averaged, decimal_text, floors, whole_vector
from partyfold.llm.storage import written

_LAST = (1 << 63) - 1


def first_centroids(points: DataFrame, clusters: int, seed: int) -> list[np.ndarray]:
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(draw.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    return [np.array([r["vector"] for r in rows], np.int64)] if rows else []


def clustered(
    vectors: DataFrame, dims: int = 64, factor: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Vectors with their cluster, and the clusters.

    `vectors` has `vec_id` and `embedding`. The first table has `vec_id, cluster, distance` (squared), the
    second `cluster, centroid, centroid_sha256, cluster_inertia, inertia` with a row for each centroid.
    """
    spark = vectors.sparkSession
    points = written(
        vectors.where(whole_vector(F.col("embedding")) & (F.size("embedding") == dims)).select(
            F.col("vec_id").cast("bigint").alias("vec_id"), floors(F.col("embedding"), factor, dims).alias("vector")
        ),
        "vectors",
    )
    centroids = averaged(points, first_centroids(points, clusters, seed), dims, rounds, deviation=True)
    placed = points.select("vec_id").limit(0).selectExpr("vec_id", "0 AS cluster", "0L AS distance")
    if centroids:
        found = assigned(points, centroids, dims, deviation=True)
        placed = written(
            found.select("vec_id", F.col("numbers")[0].alias("cluster"), F.col("distances")[0].alias("distance")),
            "assigned",
        )
    sums = {
        r["cluster"]: int(r["total"])
        for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    inertia = min(sum(sums.values()), _LAST)
    rows = [
        (i, c.tolist(), sha256(decimal_text(c).encode()).hexdigest(), min(sums.get(i, 0), _LAST), inertia)
        for i, c in enumerate(centroids[0] if centroids else [])
    ]
    schema = "cluster int, centroid array<bigint>, centroid_sha256 string, cluster_inertia bigint, inertia bigint"
    return placed, spark.createDataFrame(rows, schema)


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` of each vector."""
    placed, centroids = clustered(vectors, **options)
    return placed.join(F.broadcast(centroids.drop("centroid")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
