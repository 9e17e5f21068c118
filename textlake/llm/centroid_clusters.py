"""Clusters around centroids (k-means on whole numbers), in Spark expressions only.

The centroids are literals of the plan: an assignment is a projection over the vectors, and an
update is one aggregation with a sum column for each component. All arithmetic is on whole numbers,
so neither the layout nor a retried task changes a result. What reaches the driver is
``clusters`` rows of sums in each round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.llm.storage import Scratch

DIMS, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1"
# A component beyond this counts as this, so that a squared distance fits in a long.
LARGEST = 1 << 27

Centroids = list[tuple[int, ...]]


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``, of the vectors that are complete.

    Complete are vectors of exactly ``dims`` components, none of them null, infinite or NaN.
    Components beyond ``LARGEST`` are cut to it.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    whole = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))),
    )
    complete = F.coalesce((F.size("embedding") == dims) & finite, F.lit(False))
    return vectors.where(complete).select("vec_id", whole.alias("v"))


def _distance(centroid: Sequence[int]) -> Column:
    squares = F.zip_with("v", F.lit(np.array(centroid, np.int64)), lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)


def nearest_centroid(centroids: Centroids) -> Column:
    """``distance, cluster`` of the nearest centroid of ``v``; of equally near ones the first."""
    return F.array_min(
        F.array(
            *[
                F.struct(_distance(c).alias("distance"), F.lit(k).alias("cluster"))
                for k, c in enumerate(centroids)
            ]
        )
    )


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: str = SEED) -> Centroids:
    """The vectors whose ``sha256(seed:vec_id)`` is least; of equal numbers, the least vector.

    Every partition keeps ``clusters`` rows at most. Vectors without a number are not chosen.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    least = whole.where("vec_id IS NOT NULL").orderBy(key, "v").limit(clusters)
    return [tuple(row["v"]) for row in least.collect()]


def next_centroids(whole: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid as the floor of its vectors' mean; one without vectors stays."""
    dims = len(centroids[0])
    assigned = whole.select(nearest_centroid(centroids)["cluster"].alias("cluster"), "v")
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)]
    found = {row["cluster"]: row for row in assigned.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect()}
    return [
        tuple(found[k][f"s{i}"] // found[k]["n"] for i in range(dims)) if k in found else centroid
        for k, centroid in enumerate(centroids)
    ]


def centroid_digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, Centroids]:
    """``vec_id, cluster, distance`` of every complete vector, and the final centroids.

    Vectors that are null, of another length or not finite have no row; a repeated row has one
    for each time it occurs; ``vec_id`` may be of any type, repeated or null. Where there are fewer vectors
    than ``clusters``, each numbered one begins a cluster. An empty table, or one where no vector has
    a number to be chosen by, gives no rows. Other columns are not looked at.
    """
    whole = whole_vectors(vectors, dims, scale)
    centroids = first_centroids(whole, clusters, seed)
    if not centroids:
        nothing = whole.limit(0).selectExpr("vec_id", "cast(null AS int) AS cluster", "cast(null AS bigint) AS distance")
        return nothing, []
    for _ in range(rounds):
        centroids = next_centroids(whole, centroids)
    placed = whole.select("vec_id", nearest_centroid(centroids).alias("at"))
    return placed.select("vec_id", "at.cluster", "at.distance"), centroids


def cluster_report(vectors: DataFrame, **settings) -> DataFrame:
    """The rows of ``cluster_vectors`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Inertia is the sum of distances over the cluster and over all. Sums that do not fit in a long are null.
    """
    spark = vectors.sparkSession
    placed, centroids = cluster_vectors(vectors, **settings)
    placed = Scratch(spark, "clusters").keep(placed, "placed")
    total = F.sum(F.col("distance").cast("decimal(20,0)")).alias("total")
    sums = {row["cluster"]: int(row["total"]) for row in placed.groupBy("cluster").agg(total).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    rows = [
        (k, fits(sums.get(k, 0)), fits(sum(sums.values())), centroid_digest(c)) for k, c in enumerate(centroids)
    ]
    known = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    # No more rows than there are clusters.
    return placed.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
