import hashlib
import math
import random

import numpy as np
import pytest

from zonereach.llm.centroids import Centroids, Rotation, cluster, largest, points


def brute(rows, count=16, rounds=3, dims=64, scale=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * float(np.float32(x))) for x in v]))
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted((name(i), v) for i, v in kept)[:count]]
    measure = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(measure(v)[1], []).append(v)
        centres = [[sum(x) // len(own[k]) for x in zip(*own[k])] if k in own else c for k, c in enumerate(centres)]
    found = [(i, *measure(v)) for i, v in kept]
    inertia = {}
    for _, d, k in found:
        inertia[k] = inertia.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), digest[k]) for i, d, k in found), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def vectors(seed, n, dims, spread=0.2, means=5):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (means, dims)) * np.where(np.arange(dims) < 6, 1.0, 0.1)
    x = centre[rng.integers(0, means, n)] + rng.normal(0, spread, (n, dims)) * np.where(np.arange(dims) < 6, 1.0, 0.1)
    return [(i, [float(np.float32(c)) for c in row]) for i, row in enumerate(x)]


def test_against_brute_force(spark, scratch):
    rows = vectors(1, 300, 64)
    rows += [(0, rows[5][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1])] + [(1000 + i, rows[9][1]) for i in range(30)]
    bad = [(500, None), (501, []), (502, [0.1] * 63), (503, [0.1] * 65), (504, [None] + [0.1] * 63), (505, [float("nan")] * 64), (506, [float("-inf")] + [0.0] * 63)]
    rows += bad + [(600, [0.0] * 64), (601, [-0.001] * 64), (602, [3000.0] * 64)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    assert got(cluster(df, scratch)) == brute(rows)


@pytest.mark.parametrize("n,dims,count,rounds,leading", [(40, 3, 5, 6, 1), (40, 3, 5, 0, 3), (3, 4, 16, 2, 12), (60, 2, 30, 4, 2)])
def test_other_sizes_and_ties(spark, scratch, n, dims, count, rounds, leading):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(dims)]) for i in range(n)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    result = cluster(df, scratch, centroids=count, rounds=rounds, dims=dims, scale=8, leading=leading)
    assert got(result) == brute(rows, count, rounds, dims, 8)


def test_nothing_to_cluster(spark, scratch):
    for rows in ([], [(1, None, "x", 1), (2, [0.5], "x", 1)]):
        assert cluster(spark.createDataFrame(rows, SCHEMA), scratch).collect() == []


def test_components_too_large_are_an_error(spark, scratch):
    df = spark.createDataFrame([(1, [float(largest(64))] + [0.0] * 63)], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        cluster(df, scratch)


def test_bounds_leave_out_most_centroids(spark):
    rows = vectors(2, 2000, 64, spread=0.1, means=16)
    data = points(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    rotation = Rotation.of(data, 12)
    assert np.allclose(rotation.axes.T @ rotation.axes, np.eye(12))
    x = np.array([r.point for r in data.orderBy("vec_id").collect()], np.int64)
    centres = Centroids(x[np.random.default_rng(0).permutation(2000)[:40]], rotation)
    lead, rest = rotation(x.astype(np.float64))
    found, distance, measured = centres.nearest(x, lead, rest)
    every = ((x[:, None, :] - centres.rows[None]) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert measured < 0.4 * every.size
    # Points at the far end of what 64 bits hold, and a mean far away.
    far = (largest(64) - 1 - x[:100] % 7).astype(np.int64)
    centres = Centroids(far[:9], rotation)
    found, distance, _ = centres.nearest(far, *rotation(far.astype(np.float64)))
    every = ((far[:, None, :] - centres.rows[None]) ** 2).sum(axis=2)
    assert (found == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
