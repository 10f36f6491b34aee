"""Centroid clustering: Lloyd rounds whose assignments are Orchard searches, in whole numbers throughout.

Every centroid has the list of all others sorted by their distance to it. A vector
starts at some centroid and walks its list. A centroid that is nearer than the
present one, or as near with a smaller number, becomes the present one and its list
is walked from the start. Centroids once met are marked and not measured again. The
walk ends where the list's distance is strictly beyond twice the distance to the
present centroid: by the triangle inequality nothing behind can be as near.

Distances are squared and exact: components are whole numbers of at most ``BOUND``
and up to 64 of them, so a squared distance fits 64 bits; larger ones are refused.
The driver and each task hold ``k`` centroids and their lists, never vectors; a round
brings one row of sums per cluster to the driver.

Vectors that are null, of another length, or hold null or non-finite components take
no part. Rows with a null id take part but cannot become first centroids. Repeated ids
are separate rows; ties between first centroids of one id go to the smaller vector.
With fewer vectors than centroids all of them become centroids; without any, the
result is empty. Other columns are not read.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BOUND = 1 << 27
CELLS = 1 << 20  # marks or components held at once


def whole_vectors(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: kept vectors as whole numbers ``floor(scale * x)``, stored once."""
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    floors = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    small = F.forall(floors, lambda x: F.abs(x) <= BOUND)
    checked = F.when(small, floors.cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"a component is beyond {BOUND}")).cast("array<int>")
    )
    kept = vectors.where(v.isNotNull() & (F.size(v) == dim) & good)
    return materialize(kept.select(F.col(id_col).cast("long").alias("vec_id"), checked.alias("v")), "vectors")


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors of the ``k`` smallest digests of salt and id, in their order."""
    name = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all centroids, itself first, by distance and number; and the squared distances."""
    k = len(centroids)
    apart = np.empty((k, k), np.int64)
    for c in range(k):
        gap = centroids - centroids[c]
        apart[c] = (gap * gap).sum(axis=1)
    own = np.arange(k)
    shown = apart.copy()
    shown[own, own] = -1
    order = np.argsort(shown, axis=1, kind="stable")
    return order.astype(np.int32), np.take_along_axis(apart, order, 1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, lists: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; ties to the smaller number.

    All vectors walk at once, each its own way: one step takes the next centroid
    of every walk that has not ended.
    """
    n, k = len(vectors), len(centroids)

    def measure(rows, at):
        gap = vectors[rows] - centroids[at]
        return (gap * gap).sum(axis=1)

    now = np.zeros(n, np.int64)
    best = measure(slice(None), now)
    place = np.ones(n, np.int64)  # the first of a list is the centroid itself
    marked = np.zeros((n, k), bool)
    marked[:, 0] = True
    walking = np.arange(n)
    while len(walking):
        walking = walking[place[walking] < k]
        here, step = now[walking], place[walking]
        # squared distances beyond four times the square are strictly beyond twice the distance
        walking = walking[apart[here, step] <= 4 * best[walking]]
        found = lists[now[walking], place[walking]]
        place[walking] += 1
        new = ~marked[walking, found]
        rows, found = walking[new], found[new]
        marked[rows, found] = True
        far = measure(rows, found)
        nearer = (far < best[rows]) | ((far == best[rows]) & (found < now[rows]))
        rows, found = rows[nearer], found[nearer]
        now[rows], best[rows], place[rows] = found, far[nearer], 1
    return now, best


def _batches(batches, dim: int, k: int):
    """Ids and vectors of slices small enough for their marks."""
    rows = max(1, CELLS // max(k, dim))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)


def move(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floored means of the vectors nearest to each centroid; centroids without any stay."""
    k, dim = centroids.shape
    lists, apart = neighbour_lists(centroids)

    def sums(batches):
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for _, v in _batches(batches, dim, k):
            cluster, _ = nearest(v, centroids, lists, apart)
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            at = cluster[order][first]
            total[at] += np.add.reduceat(v[order], first)
            count += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(count)
        arrays = [pa.array(used, pa.int32()), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "n", "s"])

    # one row per task and cluster, then per cluster
    parts = vectors.select("vec_id", "v").mapInArrow(sums, "cluster int, n long, s array<long>")
    added = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i].cast("decimal(38,0)")) for i in range(dim)]).alias("s")
    )
    moved = centroids.copy()
    for row in added.collect():
        moved[row["cluster"]] = [int(x) // row["n"] for x in row["s"]]
    return moved


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    k, dim = centroids.shape
    lists, apart = neighbour_lists(centroids)

    def run(batches):
        for ids, v in _batches(batches, dim, k):
            cluster, distance = nearest(v, centroids, lists, apart)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster(
    vectors: DataFrame,
    k: int,
    rounds: int,
    dim: int,
    scale: int = 256,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Every kept vector with its cluster after ``rounds`` rounds, and the clusters' figures.

    ``vec_id, cluster, distance`` (squared), ``cluster_inertia`` and ``inertia`` (the
    distances added up over the cluster and over all), ``centroid_sha256`` (of the
    final centroid's components in decimal, joined by commas).
    """
    if dim > 64:
        raise ValueError("exact distances need at most 64 components")
    kept = whole_vectors(vectors, dim, scale, id_col, vector_col)
    centroids = first_centroids(kept, k, salt)
    if not len(centroids):
        nothing = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], nothing)
    for _ in range(rounds):
        centroids = move(kept, centroids)
    placed = materialize(assign(kept, centroids), "clusters")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    names = [(c, sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = vectors.sparkSession.createDataFrame(names, "cluster int, centroid_sha256 string")
    figures = sums.join(named, "cluster").crossJoin(sums.agg(F.sum("cluster_inertia").alias("inertia")))
    # at most k rows
    return placed.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
