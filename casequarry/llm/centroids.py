"""Centroid clustering of whole-number vectors over a kept matrix of dot products.

Every vector keeps its exact dot products with all centroids. When the centroids move, a product
changes only by the components in which its centroid moved, so a pass multiplies those alone and
recomputes the nearest centroid from ``|x|^2 + |c|^2 - 2 x.c``. Sums of clusters change only by the
vectors that changed their cluster. A pass reads and writes each vector once, without a shuffle; what
reaches the driver is one number per centroid and component, whatever the number of vectors.

Defined results: a vector that is null, has another length, or a component that is null or not finite
takes no part. Repeated rows are vectors of their own. Where start hashes tie (repeated ids), the
smaller components come first; a null id has no hash and comes last. Fewer vectors than centroids give
fewer centroids; no vectors give no rows. Components beyond ``LARGEST`` after scaling are refused, as
64-bit distances could not hold them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.storage import materialize

CLUSTERS = 16
ROUNDS = 3
SIZE = 64
SCALE = 64
LARGEST = 1 << 27

LONGS = T.ArrayType(T.LongType())


def whole_numbers(
    vectors: DataFrame, vec_id: str, embedding: str, size: int = SIZE, scale: int = SCALE
) -> DataFrame:
    """``(id, x)``: the usable vectors with components ``floor(scale * component)``."""
    number = F.col(embedding).cast("array<double>")
    usable = (F.size(number) == size) & F.forall(
        number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(math.inf))
    )
    return vectors.where(usable).select(
        F.col(vec_id).alias("id"), F.transform(number, lambda v: F.floor(v * scale)).alias("x")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = np.arange(0, n * width + 1, max(width, 1), dtype=np.int32)[: n + 1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def _product(x: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Exact product of whole numbers, in doubles where no partial sum can lose a digit."""
    largest = int(np.abs(x).max(initial=0)) * int(np.abs(move).max(initial=0)) * max(len(move), 1)
    if largest < 1 << 53:
        return np.rint(x.astype(np.float64) @ move.astype(np.float64)).astype(np.int64)
    return x @ move


def _advance(state: DataFrame, centroids: np.ndarray, moves: np.ndarray) -> DataFrame:
    """Products and nearest centroids after the centroids moved by ``moves``.

    ``left`` is the cluster of the vector before, -1 at first.
    """
    schema = T.StructType(
        [
            state.schema["id"],
            T.StructField("x", LONGS),
            T.StructField("dots", LONGS),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
            T.StructField("left", T.IntegerType()),
        ]
    )
    squares = (centroids * centroids).sum(axis=1)
    k, width = centroids.shape
    # Per centroid the components in which it moved; those of others are not touched.
    changed = [(j, np.flatnonzero(moves[j])) for j in range(k) if moves[j].any()]

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), width)
            dots = _matrix(batch.column("dots"), k).copy()
            for j, places in changed:
                dots[:, j] += _product(x[:, places], moves[j, places])
            distances = squares - 2 * dots
            nearest = distances.argmin(axis=1)  # the first of equal ones
            distance = distances[np.arange(len(x)), nearest] + (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("x"),
                    _lists(dots),
                    pa.array(nearest, pa.int32()),
                    pa.array(distance, pa.int64()),
                    batch.column("cluster"),
                ],
                names=schema.fieldNames(),
            )

    return state.mapInArrow(work, schema)


def _moved(state: DataFrame, k: int, width: int) -> list:
    """Rows ``(cluster, pos, total)``: what joined a cluster less what left it; pos -1 counts."""

    def work(batches):
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), width)
            x = np.hstack([x, np.ones((len(x), 1), np.int64)])
            for column, sign in (("cluster", 1), ("left", -1)):
                member = batch.column(column).to_numpy(zero_copy_only=False)
                for j in np.unique(member[member >= 0]):
                    total[j] += sign * x[member == j].sum(axis=0)
        j, pos = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(j, pa.int32()),
                pa.array(np.where(pos == width, -1, pos), pa.int32()),
                pa.array(total[j, pos], pa.int64()),
            ],
            names=["cluster", "pos", "total"],
        )

    moved = state.where(F.col("cluster") != F.col("left")).select("x", "cluster", "left")
    parts = moved.mapInArrow(work, "cluster int, pos int, total long")
    return parts.groupBy("cluster", "pos").agg(F.sum("total").alias("total")).collect()


def start_hash(seed: str, vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    scale: int = SCALE,
    seed: str = "1",
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per usable vector.

    The centroids start as the vectors with the smallest SHA-256 of ``seed:vec_id`` and move
    ``rounds`` times to the rounded-down mean of their vectors; empty ones stay.
    """
    id_type = vectors.schema[vec_id].dataType
    empty = f"`{vec_id}` {id_type.simpleString()}, cluster int, distance long, cluster_inertia long, "
    empty += "inertia long, centroid_sha256 string"
    spark = vectors.sparkSession
    kept = materialize(whole_numbers(vectors, vec_id, embedding, size, scale), "centroid-vectors")
    largest = kept.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0]
    if largest is None:
        return spark.createDataFrame([], empty)
    if largest > LARGEST:
        raise ValueError(f"scaled components up to {largest} are beyond {LARGEST}")
    first = kept.orderBy(start_hash(seed, F.col("id")).asc_nulls_last(), "x").limit(clusters)
    centroids = np.array([r["x"] for r in first.select("x").collect()], np.int64)
    k, width = centroids.shape
    state = kept.select(
        "id",
        "x",
        F.array_repeat(F.lit(0).cast("long"), k).alias("dots"),
        F.lit(-1).alias("cluster"),
    )
    moves = centroids.copy()
    totals = [[0] * (width + 1) for _ in range(k)]
    for number in range(rounds + 1):
        state = materialize(_advance(state, centroids, moves), "centroid-state")
        if number == rounds:
            break
        for row in _moved(state, k, width):
            totals[row["cluster"]][row["pos"]] += row["total"]
        means = [
            [v // t[-1] for v in t[:-1]] if t[-1] else c for t, c in zip(totals, centroids.tolist())
        ]
        moves = np.array(means, np.int64) - centroids
        centroids = centroids + moves
        if not moves.any():  # nothing changes any more
            break
    sums = dict(state.groupBy("cluster").agg(F.sum("distance")).collect())
    named = [
        (j, sums[j], sum(sums.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for j, c in enumerate(centroids.tolist())
        if j in sums
    ]
    told = spark.createDataFrame(
        named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    # One row per centroid.
    return state.join(F.broadcast(told), "cluster").select(
        F.col("id").alias(vec_id),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )
