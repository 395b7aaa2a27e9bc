"""Centroid clustering in integers, filtered by bounds in PCA-rotated coordinates.

A vector is a point of integers. Beside it lie its leading coordinates after a rotation by the principal axes of all
points, and the norm of the rest of it. For a point and a centroid, the squared distance of the leading coordinates plus
the squared difference of the rest norms is never above their squared distance. A point is measured exactly against the
centroid of the lowest bound and then only against those whose bound is not above that distance; these distances are
integers, so that assignments, ties and sums do not depend on order or rounding.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Scratch

LEADING = 12
PAIRS = 20_000
# Stored coordinates are 32-bit: bounds give way by this share of the norms and by a fixed amount.
GIVE, LEAST_GIVE = 1e-6, 1e-3

POINTS = "vec_id long, point array<long>"
ROTATED = "vec_id long, point array<long>, lead array<float>, rest float"
MOMENTS = "sums array<double>"
SUMS = "cluster int, n long, sums array<long>"
ASSIGNED = "vec_id long, cluster int, distance long"


def largest(dims: int) -> int:
    """Components below it have squared distances within 64 bits."""
    return math.isqrt((1 << 62) // dims) // 2


def points(vectors: DataFrame, dims: int = 64, scale: float = 64, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Vectors with exactly ``dims`` components, all finite, as integers floor(scale * x): vec_id, point.

    Null vectors and those with a null, NaN or infinite component or another length are left out. A component too large
    for exact 64-bit distances ends the job with an error.
    """
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(v, lambda x: F.lit(float(scale)) * x.cast("double"))
    kept = vectors.where(v.isNotNull() & (F.size(v) == dims) & F.coalesce(finite, F.lit(False)))
    fits = F.forall("_scaled", lambda x: F.abs(x) < float(largest(dims)))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("_scaled")).select(
        "vec_id",
        F.when(fits, F.transform("_scaled", lambda x: F.floor(x).cast("long")))
        .otherwise(F.raise_error(F.lit("a vector's component is too large for exact distances")))
        .alias("point"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class Rotation:
    """Principal axes of the points: the mean and the ``leading`` directions of the largest variance."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes

    @classmethod
    def of(cls, data: DataFrame, leading: int) -> Rotation:
        """From the sums, and sums of products, of all points; a task gives its own once."""

        def partial(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    x = _matrix(batch.column(0)).astype(np.float64)
                    own = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
                    total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

        rows = (
            data.select("point")
            .mapInArrow(partial, MOMENTS)
            .select(F.posexplode("sums").alias("at", "value"))
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
            .collect()
        )
        sums = np.zeros(len(rows))
        for r in rows:
            sums[r.at] = r.value
        dims = (math.isqrt(4 * len(rows) - 3) - 1) // 2
        n, mean = sums[0], sums[1 : dims + 1] / sums[0]
        spread = sums[dims + 1 :].reshape(dims, dims) / n - np.outer(mean, mean)
        # In ascending order of variance.
        _, axes = np.linalg.eigh((spread + spread.T) / 2)
        return cls(mean, axes[:, ::-1][:, : min(leading, dims)])

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and rest norm of each point."""
        centred = x - self.mean
        lead = centred @ self.axes
        rest = np.sqrt(np.maximum((centred**2).sum(axis=1) - (lead**2).sum(axis=1), 0))
        return lead.astype(np.float32), rest.astype(np.float32)

    def rotate(self, data: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    lead, rest = self(_matrix(batch.column(1)).astype(np.float64))
                    offsets = pa.array(np.arange(len(lead) + 1) * lead.shape[1], pa.int32())
                    lists = pa.ListArray.from_arrays(offsets, pa.array(lead.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), lists, pa.array(rest)], ["vec_id", "point", "lead", "rest"]
                    )

        return data.mapInArrow(run, ROTATED)


class Centroids:
    """Centroids in integers, with their rotated form."""

    def __init__(self, rows: np.ndarray, rotation: Rotation):
        self.rows = rows
        lead, rest = rotation(rows.astype(np.float64))
        self.lead, self.rest = lead.astype(np.float64), rest.astype(np.float64)
        self.norm = np.sqrt((self.lead**2).sum(axis=1)) + self.rest
        self.size = (self.lead**2).sum(axis=1)

    def exact(self, x: np.ndarray, at: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.int64)
        for a in range(0, len(at), PAIRS):
            own = slice(a, a + PAIRS)
            out[own] = ((x[at[own]] - self.rows[cluster[own]]) ** 2).sum(axis=1)
        return out

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (the smallest among equals), squared distance, and distances measured."""
        lead, rest = lead.astype(np.float64), rest.astype(np.float64)
        own = (lead**2).sum(axis=1)
        bound = own[:, None] + self.size - 2 * (lead @ self.lead.T) + (rest[:, None] - self.rest) ** 2
        give = GIVE * ((np.sqrt(own) + rest)[:, None] + self.norm) + LEAST_GIVE
        bound = np.maximum(np.sqrt(np.maximum(bound, 0)) - give, 0) ** 2
        rows = np.arange(len(x))
        first = bound.argmin(axis=1)
        best = self.exact(x, rows, first)
        rest_of = bound <= best[:, None] * (1 + 1e-12)
        rest_of[rows, first] = False
        at, other = np.nonzero(rest_of)
        at, other = np.concatenate([rows, at]), np.concatenate([first, other])
        distance = np.concatenate([best, self.exact(x, at[len(x) :], other[len(x) :])])
        order = np.lexsort((other, distance, at))
        head = order[np.append(True, at[order][1:] != at[order][:-1])] if len(order) else order
        return other[head], distance[head], len(at)

    def batches(self, found):
        for batch in found:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                cluster, distance, _ = self.nearest(x, _matrix(batch.column(2)), batch.column(3).to_numpy())
                yield batch.column(0), x, cluster, distance

    def assign(self, rotated: DataFrame) -> DataFrame:
        def run(found):
            for ids, _, cluster, distance in self.batches(found):
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
                )

        return rotated.mapInArrow(run, ASSIGNED)

    def moved(self, rotated: DataFrame, rotation: Rotation) -> Centroids:
        """The componentwise floor of the mean of each centroid's points; a centroid without points stays."""
        count, dims = self.rows.shape

        def partial(found):
            sums, n = np.zeros((count, dims), np.int64), np.zeros(count, np.int64)
            for _, x, cluster, _ in self.batches(found):
                order = np.argsort(cluster, kind="stable")
                head = np.flatnonzero(np.append(True, cluster[order][1:] != cluster[order][:-1]))
                own = cluster[order[head]]
                sums[own] += np.add.reduceat(x[order], head, axis=0)
                n += np.bincount(cluster, minlength=count)
            some = np.flatnonzero(n)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(n[some], pa.int64()), pa.array(list(sums[some]), pa.list_(pa.int64()))],
                    ["cluster", "n", "sums"],
                )

        totals = (
            rotated.mapInArrow(partial, SUMS)
            .select("cluster", "n", F.posexplode("sums").alias("at", "total"))
            .groupBy("cluster", "at")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
            .collect()
        )
        rows = self.rows.copy()
        for r in totals:
            rows[r.cluster, r.at] = int(r.total) // r.n
        return Centroids(rows, rotation)


def cluster(
    vectors: DataFrame,
    scratch: Scratch,
    centroids: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64,
    leading: int = LEADING,
    seed: str = "1:",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Clusters of vectors: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    For which vectors take part, see ``points``; the others get no row. The first centroids are the points with the
    smallest sha256 of ``seed`` and the id (null: nothing), of repeated ids the smallest point first; with fewer points
    there are fewer centroids. Each of ``rounds`` assigns every point to the nearest centroid, the smaller number among
    equals, and moves every centroid that has points to the floor of their mean. Repeated rows are points of their own.
    Other columns are not read. An empty table gives no rows.

    The driver holds the centroids, the sums of their points and the moments of the components: ``centroids * dims``
    and ``dims * dims`` numbers, whatever the number of vectors.
    """
    data = scratch.table(points(vectors, dims, scale, vec_id, vector), "points")
    name = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = data.select(name.alias("name"), "point").orderBy("name", "point").limit(centroids).collect()
    spark = vectors.sparkSession
    if not first:
        none = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], none)
    rotation = Rotation.of(data, leading)
    rotated = scratch.table(rotation.rotate(data), "rotated")
    scratch.drop(data)
    now = Centroids(np.array([r.point for r in first], np.int64), rotation)
    for _ in range(rounds):
        now = now.moved(rotated, rotation)
    assigned = scratch.table(now.assign(rotated), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r.cluster: int(r.s) for r in sums}
    everything = sum(inertia.values())
    if everything >= 1 << 63:
        raise ValueError("the inertia exceeds 64 bits")
    about = [
        (i, inertia[i], everything, hashlib.sha256(",".join(map(str, now.rows[i].tolist())).encode()).hexdigest()) for i in sorted(inertia)
    ]
    # One row a centroid.
    named = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
