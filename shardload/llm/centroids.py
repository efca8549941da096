"""Centroid clustering with an n-simplex projection.

Vectors become integers ``floor(scale * x)``.  Their distances to a few pivots are
taken once and kept as apex coordinates: the pivots span a simplex, a vector is
the apex above it, its coordinates in the span and its height over it follow from
the distances alone.  For two apexes the distance with both heights on one side is
a lower bound of the true one, with the heights on opposite sides an upper bound.
In each round a vector is compared, exactly and in integers, with the centroid of
least lower bound and then only with those whose lower bound exceeds neither that
distance nor the least upper bound.  What a task hands on is a row of sums for each centroid.

Defined results: only vectors with exactly ``dims`` components, none null, NaN or
infinite, take part, others give no row; repeated rows are vectors of their own;
a null id is hashed as the empty text; of equal ids the smaller vector comes first;
with fewer vectors than ``k`` there are as many centroids, with none no rows; of
equal distances the smaller number wins; extra columns are ignored.  A component
beyond ``BOUND`` after scaling has no distance in a BIGINT: the query fails and says so.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardload.llm.common import saved

K, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
#: Pivots at most; one is taken only if its height over those before is at least this share of the first distance.
PIVOTS, HEIGHT = 8, 0.05
#: Slack of the squared bounds, as a share of the squared distances they come from: far above rounding.
SLACK = 1e-7
BOUND = 1 << 27
#: Vectors compared at once.
BLOCK = 4096


@dataclass
class Simplex:
    """Pivots and the lower triangular matrix of their own coordinates (the first is the origin)."""
    pivots: np.ndarray
    base: np.ndarray

    def apex(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates of integer vectors: in the span of the pivots, the height last."""
        d = np.stack([_squared(vectors, p) for p in self.pivots], axis=1).astype(float)
        return _apex(self.base, d)


def _squared(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    diff = vectors - one
    return np.einsum("ij,ij->i", diff, diff)


def _apex(base: np.ndarray, d: np.ndarray) -> np.ndarray:
    """From squared distances ``d`` (rows, pivots): 2 b.x = d_0 - d_i + |b|^2 for every pivot's coordinates b."""
    if len(base) == 0:
        return np.sqrt(d[:, :1])
    right = (d[:, :1] - d[:, 1:] + (base * base).sum(axis=1)) / 2
    x = right @ np.linalg.inv(base).T
    height = np.sqrt(np.maximum(0, d[:, 0] - (x * x).sum(axis=1)))
    return np.column_stack([x, height])


def simplex(candidates: np.ndarray, pivots: int = PIVOTS) -> Simplex:
    """The first candidate, then again and again the one highest above the span of those taken."""
    taken, base = [0], np.zeros((0, 0))
    first = _squared(candidates, candidates[0]).astype(float)
    while len(taken) < pivots:
        d = np.stack([_squared(candidates, candidates[i]) for i in taken], axis=1).astype(float)
        coordinates = _apex(base, d)
        at = int(np.argmax(coordinates[:, -1]))
        if coordinates[at, -1] <= max(HEIGHT * np.sqrt(first.max()), 1e-9):
            break
        base = np.pad(base, ((0, 1), (0, 1)))
        base[-1] = coordinates[at]
        taken.append(at)
    return Simplex(candidates[taken], base)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of the distances of apexes ``a`` (rows) and ``b`` (columns), with slack."""
    span = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    slack = SLACK * ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]) + 0.5
    low = span + (a[:, -1:] - b[:, -1]) ** 2 - slack
    high = span + (a[:, -1:] + b[:, -1]) ** 2 + slack
    return low, high


def nearest(vectors: np.ndarray, apex: np.ndarray, centroids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every vector, and how many comparisons it took.
    ``at`` are the apexes of the centroids."""
    low, high = bounds(apex, at)
    cluster = np.argmin(low, axis=1).astype(np.int32)
    diff = vectors - centroids[cluster]
    best = np.einsum("ij,ij->i", diff, diff)
    near = low <= np.minimum(best, high.min(axis=1))[:, None]
    near[np.arange(len(near)), cluster] = False
    for j in range(len(centroids)):
        rows = np.flatnonzero(near[:, j])
        d = _squared(vectors[rows], centroids[j])
        less = (d < best[rows]) | (d == best[rows]) & (j < cluster[rows])
        best[rows[less]], cluster[rows[less]] = d[less], j
    return cluster, best, len(near) + int(near.sum())


def kept_vectors(vectors: DataFrame, dims: int, scale: int, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, v array<int>)`` of the vectors that take part."""
    wide = F.col("x").cast("array<double>")
    good = (F.size("x") == dims) & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))

    def scaled(x):
        y = F.floor(x * scale)
        return F.when(F.abs(x * scale) < BOUND, y).otherwise(
            F.raise_error(F.lit(f"a component times {scale} is beyond {BOUND}")).cast("long")).cast("int")

    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("x")).where(F.coalesce(good, F.lit(False)))
            .select("vec_id", F.transform(wide, scaled).alias("v")))


def _matrix(column: pa.Array, dims: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dims)


def _tasks(prepared: DataFrame, centroids: np.ndarray, shape: Simplex, each, schema: str) -> DataFrame:
    """``each(batch, vectors, cluster, distance)`` over blocks of the prepared vectors."""
    at, dims = shape.apex(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = each()
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                v = _matrix(part.column(1), dims, np.int64)
                got = state.block(part, v, *nearest(v, _matrix(part.column(2), at.shape[1], float), centroids, at)[:2])
                if got is not None:
                    yield got
        if (got := state.end()) is not None:
            yield got

    return prepared.mapInArrow(run, schema)


class _Sums:
    """Rows and componentwise sums of what a task assigns to each centroid."""

    def __init__(self, k: int, dims: int):
        self.n, self.sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)

    def block(self, part, v, cluster, distance):
        order = np.argsort(cluster, kind="stable")
        met, first = np.unique(cluster[order], return_index=True)
        self.n += np.bincount(cluster, minlength=len(self.n))
        self.sums[met] += np.add.reduceat(v[order], first, axis=0)

    def end(self):
        met = np.flatnonzero(self.n)
        return pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(self.n[met]), *map(pa.array, self.sums[met].T.copy())],
                                          ["cluster", "n", *(f"s{i}" for i in range(self.sums.shape[1]))])


class _Rows:
    def block(self, part, v, cluster, distance):
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    def end(self):
        return None


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED,
            pivots: int = PIVOTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part.

    The first centroids are the ``k`` vectors whose ids hash lowest with ``seed``.  The driver holds ``k`` centroids
    and ``k`` rows of sums; the vectors with their coordinates are written once and read in each round."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, dims, scale, vec_id, vector)
    label = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select("v", label.alias("h")).orderBy("h", "v").limit(k).collect()  # k rows
    id_type = kept.schema["vec_id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r.v for r in first], dtype=np.int64)
    shape = simplex(centroids, pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                apex = shape.apex(_matrix(part.column(1), dims, np.int64))
                at = pa.array(np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(at, pa.array(apex.ravel()))],
                                                 ["vec_id", "v", "apex"])

    prepared = saved(kept.mapInArrow(project, f"vec_id {id_type}, v array<int>, apex array<double>"), "cluster-vectors")
    sums = [f"s{i}" for i in range(dims)]
    schema = "cluster int, n long, " + ", ".join(f"{s} long" for s in sums)
    for _ in range(rounds):
        size = centroids.shape
        total = (_tasks(prepared, centroids, shape, lambda: _Sums(*size), schema).groupBy("cluster")
                 .agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).collect())  # k rows
        for r in total:
            centroids[r.cluster] = [r[s] // r.n for s in sums]
    assigned = saved(_tasks(prepared, centroids, shape, _Rows, f"vec_id {id_type}, cluster int, distance long"), "cluster-rows")
    inertia = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    whole = sum(inertia.values())
    facts = spark.createDataFrame(
        [(j, d, whole, hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, d in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # k rows at most, so broadcast
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """The same rounds in SQL, every vector compared with every centroid."""
    far = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.c[i]) * (v.v[i] - c.c[i]))) AS BIGINT)"
    parts = [f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS j, v AS c
  FROM (SELECT v, sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, v LIMIT {K}))"""]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, j := j)) AS near
  FROM (SELECT v.r, c.j, {far} AS d FROM v, c{r} c) GROUP BY r)""")
        if r < ROUNDS:
            parts.append(f"""m{r} AS MATERIALIZED (SELECT j, list(m ORDER BY i) AS c FROM (
  SELECT near.j AS j, i, sum(v.v[i]) AS s, count(*) AS n, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
  FROM a{r} JOIN v USING (r), range(1, {DIMS + 1}) t(i) GROUP BY near.j, i) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (j))""")
    return ",\n".join(parts) + f"""
SELECT v.vec_id, CAST(near.j AS INTEGER) AS cluster, CAST(near.d AS BIGINT) AS distance,
  CAST(sum(near.d) OVER (PARTITION BY near.j) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} c ON c.j = near.j"""


ORACLE = _oracle()
