"""Centroid clustering of vectors: PCA-rotated filtering, verification in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.session import stage

LEADING = 16             # rotated coordinates that are stored
LARGEST = 1 << 27        # components up to this size have squared distances that fit a long
SLACK = 1e-9             # share of the squared norms by which a lower bound may be off
_SUM = "decimal(38,0)"


def whole_vectors(vectors: DataFrame, dims: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v``: each component ``x`` as ``floor(scale * x)``; other vectors go.

    A vector stays if it has ``dims`` components, none null, non-finite or
    beyond ``LARGEST`` after scaling.
    """
    x = F.col(embedding).cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(scale)))
    fits = F.forall(x, lambda c: c.isNotNull() & (F.abs(c * F.lit(scale)) <= F.lit(LARGEST)))
    return (vectors.where((F.size(embedding) == dims) & F.coalesce(fits, F.lit(False)))
            .select(F.col(vec_id).cast("bigint").alias("vec_id"), scaled.cast("array<int>").alias("v")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _moments(dims: int):
    """Per task: one row per component with its sum and the sums of its products with all components."""
    def run(batches):
        count, total, products = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            v = _matrix(batch.column("v"), dims).astype(np.float64)
            count, total, products = count + len(v), total + v.sum(axis=0), products + v.T @ v
        if count:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims), pa.int32()), pa.array([float(count)] * dims), pa.array(total),
                 pa.array(list(products), pa.list_(pa.float64()))], ["i", "n", "total", "products"])
    return run


def rotation(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes (columns, widest first) of all vectors; ``dims`` rows reach the driver."""
    parts = rows.select("v").mapInArrow(_moments(dims), "i int, n double, total double, products array<double>")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.array(
        *[F.sum(F.col("products")[j]) for j in range(dims)]).alias("products")).orderBy("i").collect()
    if not found:
        return np.zeros(dims), np.eye(dims)
    mean = np.array([r["total"] / r["n"] for r in found])
    spread = np.array([r["products"] for r in found]) / found[0]["n"] - np.outer(mean, mean)
    return mean, np.linalg.eigh((spread + spread.T) / 2)[1][:, ::-1]


def _rotate(v: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates, and the norm of what is left."""
    turned = (v - mean) @ axes
    return turned[:, :leading], np.sqrt((turned[:, leading:] ** 2).sum(axis=1))


def _store(mean: np.ndarray, axes: np.ndarray, leading: int):
    def run(batches):
        for batch in batches:
            lead, rest = _rotate(_matrix(batch.column("v"), len(mean)).astype(np.float64), mean, axes, leading)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(lead), pa.list_(pa.float64())), pa.array(rest)],
                [*batch.schema.names, "lead", "rest"])
    return run


class _Nearest:
    """The nearest of some centroids, ties to the smaller number."""

    def __init__(self, centroids: Sequence[Sequence[int]], mean: np.ndarray, axes: np.ndarray, leading: int):
        self.c = np.array(centroids, dtype=np.int64).reshape(-1, len(mean))
        self.lead, self.rest = _rotate(self.c.astype(np.float64), mean, axes, leading)
        self.size = ((self.c - mean) ** 2).sum(axis=1)

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, cluster, squared distance, and the number of centroids that were verified."""
        v = _matrix(batch.column("v"), self.c.shape[1]).astype(np.int64)
        lead, rest = _matrix(batch.column("lead"), self.lead.shape[1]), batch.column("rest").to_numpy()
        inside = (lead ** 2).sum(axis=1)
        # (a - b)^2 of leading coordinates, then of residual norms: never more than the true distance.
        least = (inside[:, None] + (self.lead ** 2).sum(axis=1) - 2 * lead @ self.lead.T
                 + (rest[:, None] - self.rest) ** 2)
        least -= SLACK * ((inside + rest ** 2)[:, None] + self.size) + 1
        guess = least.argmin(axis=1)
        bound = ((v - self.c[guess]) ** 2).sum(axis=1)
        cluster, distance = guess.astype(np.int32), bound.copy()
        checked = np.ones(len(v), dtype=np.int32)
        for k in range(len(self.c)):
            open_ = np.flatnonzero((least[:, k] <= distance) & (guess != k))
            far = ((v[open_] - self.c[k]) ** 2).sum(axis=1)
            better = (far < distance[open_]) | ((far == distance[open_]) & (k < cluster[open_]))
            cluster[open_[better]], distance[open_[better]] = k, far[better]
            checked[open_] += 1
        return v, cluster, distance, checked


def _sums(nearest: _Nearest):
    """Per task: one row per cluster with the count and the sum of each component, as decimal text."""
    def run(batches):
        dims = nearest.c.shape[1]
        count = np.zeros(len(nearest.c), dtype=object)
        total = np.zeros((len(nearest.c), dims), dtype=object)
        for batch in batches:
            if batch.num_rows:
                v, cluster, _, _ = nearest(batch)
                for k in np.unique(cluster):
                    mine = v[cluster == k]
                    count[k] += len(mine)
                    total[k] += mine.sum(axis=0)
        some = [k for k in range(len(count)) if count[k]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([int(count[k]) for k in some], pa.int64()),
             pa.array([[str(x) for x in total[k]] for k in some], pa.list_(pa.string()))], ["cluster", "n", "total"])
    return run


def _label(nearest: _Nearest):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                _, cluster, distance, checked = nearest(batch)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array(distance),
                                                  pa.array(checked)], ["vec_id", "cluster", "distance", "n_verified"])
    return run


def _moved(rows: DataFrame, nearest: _Nearest) -> list[list[int]]:
    """Centroids as the floored mean of their vectors; one row per centroid reaches the driver."""
    dims = nearest.c.shape[1]
    parts = rows.select("v", "lead", "rest").mapInArrow(_sums(nearest), "cluster int, n bigint, total array<string>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[
        F.sum(F.col("total")[j].cast(_SUM)).alias(f"s{j}") for j in range(dims)]).collect()
    centroids = nearest.c.tolist()
    for r in sums:
        centroids[r["cluster"]] = [int(r[f"s{j}"]) // r["n"] for j in range(dims)]
    return centroids


def centroid_clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
                      leading: int = LEADING, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, n_verified, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Components ``x`` become ``floor(scale * x)``. The first centroids are the ``k`` vectors with the smallest
    SHA-256 of ``seed:vec_id``; each of ``rounds`` rounds assigns every vector to the nearest one (ties: the smaller
    number) and moves each that has vectors to the exact floor of their mean. Then vectors are assigned once more.

    Vectors are stored with their ``leading`` coordinates along the principal axes of all vectors and the norm of the
    rest. The distance in these coordinates plus the squared difference of the norms is a lower bound; only centroids
    whose bound does not exceed the best distance so far are compared, in whole numbers (``n_verified`` of them).

    Vectors with another number of components, or with one that is null, non-finite or larger than ``LARGEST`` after
    scaling, are no rows of the result. Rows that share a ``vec_id`` are vectors of their own; those without one are
    never first centroids unless there are too few others. Fewer than ``k`` vectors give as many centroids. Other
    columns are ignored. Inertia that does not fit a long is null.
    """
    rows = stage(whole_vectors(vectors, dims, scale, vec_id, embedding), "cluster-vectors")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    # k rows at most.
    centroids = [r["v"] for r in rows.orderBy(rank.asc_nulls_last(), "v").limit(k).collect()]
    mean, axes = rotation(rows, dims)
    stored = stage(rows.mapInArrow(_store(mean, axes, leading), "vec_id bigint, v array<int>, lead array<double>, "
                                   "rest double"), "cluster-rotated")
    for _ in range(rounds if centroids else 0):
        centroids = _moved(stored, _Nearest(centroids, mean, axes, leading))
    labelled = stage(stored.mapInArrow(_label(_Nearest(centroids, mean, axes, leading)),
                                       "vec_id bigint, cluster int, distance bigint, n_verified int"), "cluster-labels")
    # One row per cluster.
    sums = {r["cluster"]: int(r["s"]) for r in labelled.groupBy("cluster").agg(
        F.sum(F.col("distance").cast(_SUM)).alias("s")).collect()}
    long_ = lambda x: x if x < 1 << 63 else None
    small = labelled.sparkSession.createDataFrame(
        [(i, long_(sums.get(i, 0)), long_(sum(sums.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for i, c in enumerate(centroids)],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return labelled.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "n_verified", "cluster_inertia", "inertia", "centroid_sha256")
