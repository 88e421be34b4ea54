"""Centroid clustering in exact integers, assigned by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.scratch import stage
from storepulse.llm.vectors import whole_rows

#: Components are held within this, so that a squared distance of 64 of them is a 64-bit number.
_LARGEST = 2.0**27


def quantised(rows: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(rows * scale), -_LARGEST, _LARGEST).astype(np.int64)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all centroids by rising squared distance from it (itself first;
    ties: smaller number), and those distances."""
    apart = np.stack([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    apart[np.arange(len(apart)), np.arange(len(apart))] = -1  # before any equal centroid
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(points: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number) and squared distance of every point, and the
    number of distances computed.

    Each point walks the list of its current centroid. A closer centroid becomes the
    current one and its list is walked from the start; centroids met before are marked and
    passed over. By the triangle inequality the walk may stop at a neighbour that lies
    strictly beyond twice the current distance; at exactly twice, one could still tie.
    All points of a batch take their steps together.
    """
    n, k = len(points), len(centroids)
    current = np.zeros(n, np.int64)
    best = ((points - centroids[0]) ** 2).sum(axis=1)
    visited = np.zeros((n, k), bool)
    visited[:, 0] = True
    place = np.ones(n, np.int64)
    walking, computed = np.arange(n), n
    while True:
        walking = walking[place[walking] < k]
        if not len(walking):
            return current, best, computed
        c, p = current[walking], place[walking]
        near = (apart[c, p] - 1) >> 2 < best[walking]  # not: apart > 4 * best
        walking, met = walking[near], order[c, p][near]
        place[walking] += 1
        new = ~visited[walking, met]
        rows, met = walking[new], met[new]
        visited[rows, met] = True
        far = ((points[rows] - centroids[met]) ** 2).sum(axis=1)
        computed += len(rows)
        closer = (far < best[rows]) | ((far == best[rows]) & (met < current[rows]))
        rows, met = rows[closer], met[closer]
        current[rows], best[rows], place[rows] = met, far[closer], 1


def _first_centroids(vectors: DataFrame, k: int, size: int, scale: float) -> np.ndarray:
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = (vectors.filter((F.size("embedding") == size) & whole)
            .select(drawn.alias("drawn"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
            .orderBy("drawn", "v").limit(k).collect())
    return quantised(np.array([r.v for r in rows], np.float64).reshape(len(rows), size), scale)


def _moved(vectors: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """Centroids after one round. A task adds up its vectors and returns one number per
    centroid and dimension, so what is shuffled and collected does not grow with vectors."""
    k, size = centroids.shape
    order, apart = neighbour_lists(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, rows in whole_rows(batch.column(0), [size]):
                points = quantised(rows, scale)
                found, _, _ = nearest(points, centroids, order, apart)
                by = np.argsort(found, kind="stable")
                have, starts = np.unique(found[by], return_index=True)
                sums[have] += np.add.reduceat(points[by], starts, axis=0)
                counts += np.bincount(found, minlength=k)
        c, d = np.divmod(np.arange(k * (size + 1)), size + 1)
        yield pa.record_batch({"cluster": pa.array(c, pa.int32()), "d": pa.array(d, pa.int32()),
                               "s": pa.array(np.column_stack([sums, counts]).ravel(), pa.int64())})

    parts = vectors.select("embedding").mapInArrow(add, "cluster int, d int, s long")
    totals = np.zeros((k, size + 1), object)
    for row in parts.groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        totals[row.cluster, row.d] = int(row.s)
    moved = centroids.copy()
    for c in range(k):
        if totals[c, size]:
            moved[c] = [s // totals[c, size] for s in totals[c, :size]]
    return moved


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: float = 64.0) -> DataFrame:
    """`vec_id`, `cluster`, `distance` (squared), `cluster_inertia`, `inertia`, `centroid_sha256`:
    k-means over the integers floor(scale * x).

    `vectors` has vec_id and embedding; other columns are ignored. Vectors that are null,
    have another length than `size`, or hold a null or non-finite component are not
    returned; components beyond 2**27 count as 2**27, so that distances fit 64 bits. The
    first centroids are the `k` vectors whose sha256 of `1:<vec_id>` is smallest (a null id
    reads as empty; equal ids: smaller vector); with fewer vectors there are fewer
    centroids, and without any the result is empty. A centroid moves to the floor of its
    vectors' mean; without vectors it stays. Rows that repeat an id are vectors of their
    own, and each gets its row. A sum that is beyond 64 bits is null.

    Every round is one pass. Only the centroids, `k` rows, go through the driver.
    """
    spark = vectors.sparkSession
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    centroids = _first_centroids(vectors, k, size, scale)
    shape = "vec_id long, cluster int, distance long"
    if not len(centroids):
        none = spark.createDataFrame([], f"{shape}, cluster_inertia long, inertia long, centroid_sha256 string")
        return none
    for _ in range(rounds):
        centroids = _moved(vectors, centroids, scale)
    order, apart = neighbour_lists(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows in whole_rows(batch.column(1), [size]):
                found, far, _ = nearest(quantised(rows, scale), centroids, order, apart)
                yield pa.record_batch({"vec_id": batch.column(0).take(pa.array(at)),
                                       "cluster": pa.array(found, pa.int32()), "distance": pa.array(far, pa.int64())})

    assigned = stage(vectors.mapInArrow(assign, shape), "clusters")
    spread = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    fits = lambda s: int(s) if s < 2**63 else None
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    inertia = fits(sum(r.s for r in spread))
    sums = spark.createDataFrame([(r.cluster, fits(r.s), inertia, names[r.cluster]) for r in spread],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
