import hashlib
import math
import random

import numpy as np
import pytest

from shardload.llm import centroids as C


def brute(rows, k=40, rounds=5, dims=64, scale=256, seed=2):
    """Plain Python rounds over (vec_id, vector) rows, with every vector compared with every centroid."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cent = [v for _, v in first[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        for j, vs in own.items():
            cent[j] = [sum(x) // len(vs) for x in zip(*vs)]
    got = [(i, *near(v)) for i, v in kept]
    sums = {}
    for _, d, j in got:
        sums[j] = sums.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return [(i, j, d, sums[j], sum(sums.values()), sha[j]) for i, d, j in got]


def rows_of(seed, n, spread):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, spread) for _ in range(64)] for _ in range(9)]
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(m + rnd.gauss(0, 0.05)) for m in rnd.choice(middles)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # one very common vector
    return rows


@pytest.mark.parametrize("seed,spread,k", [(1, 0.3, 40), (2, 0.0, 7), (3, 50.0, 40)])
def test_against_brute_force(spark, seed, spread, k):
    rows = rows_of(seed, 150, spread)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = C.cluster(df, k=k)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, k))


def test_edges(spark):
    v = [0.25] * 64
    rows = [(1, v), (1, v), (1, [0.5] * 64), (2, None), (3, []), (4, v[:63]), (5, v + [0.0]), (6, [None] + v[1:]),
            (7, [math.nan] + v[1:]), (8, [math.inf] + v[1:]), (9, [-math.inf] + v[1:]), (None, [-0.001] * 64), (None, None)]
    df = spark.createDataFrame([r + ("x", [1], 0.5) for r in rows],
                               "vec_id long, embedding array<float>, v string, apex array<int>, cluster double")
    got = sorted(map(tuple, C.cluster(df).collect()), key=str)
    assert got == sorted(brute(rows), key=str) and len(got) == 4
    empty = C.cluster(df.where("vec_id = -1"))
    assert empty.count() == 0 and empty.columns == C.cluster(df).columns
    with pytest.raises(Exception, match="beyond"):
        C.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<float>")).collect()


def test_bounds_hold_and_filter():
    rnd = np.random.default_rng(4)
    middles = rnd.integers(-300, 300, (40, 64))
    vectors = middles[rnd.integers(0, 40, 2000)] + rnd.integers(-20, 20, (2000, 64))
    shape = C.simplex(middles)
    assert len(shape.pivots) == C.PIVOTS
    a, b = shape.apex(vectors), shape.apex(middles)
    low, high = C.bounds(a, b)
    true = np.stack([C._squared(vectors, m) for m in middles], axis=1)
    assert (low <= true).all() and (true <= high).all()
    cluster, best, compared = C.nearest(vectors, a, middles, b)
    assert (best == true.min(axis=1)).all() and (cluster == true.argmin(axis=1)).all()
    assert compared < 0.5 * true.size  # the filter does its work on separated groups


def test_flat_pivots_are_not_taken():
    line = np.arange(10)[:, None] * np.ones((1, 64), dtype=np.int64)
    shape = C.simplex(line.astype(np.int64))
    assert len(shape.pivots) == 2
    same = C.simplex(np.ones((5, 64), dtype=np.int64))
    assert len(same.pivots) == 1 and (same.apex(np.ones((3, 64), dtype=np.int64)) == 0).all()
