"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of ``bits`` bits is cut into ``m`` segments; rows are posted under every
(segment, value).  Round ``r`` looks up all values at distance ``r`` from the
query's segments and verifies the full distance.  After round ``r`` every code
within ``m * (r + 1) - 1`` has been seen (else each segment would differ in at
least ``r + 1`` bits), so a query is finished when its k-th verified distance
is not above that; the others go on with a larger radius.

Defined results: a code is the sign bits (``> 0``) of the vector, null entries
counting as 0; rows with a null or empty vector are not indexed and ask nothing;
only the first ``bits`` entries count and missing ones are 0; ties in distance go to the smaller id; repeated rows are rows of their
own; a query finds itself; fewer than ``k`` rows give fewer results.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.llm.common import saved, small

K = 10
#: One lookup costs about as much as so many comparisons; the widest segment (masks are listed per shell).
LOOKUP_COST, MAX_WIDTH = 10, 20


def sign_code(vector: Column, bits: int = 64) -> Column:
    """BIGINT whose bit ``i`` is set if entry ``i`` is positive."""
    one = lambda i: F.when(F.get(vector, F.lit(i)) > 0, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(
        F.lit(0).cast("long"))
    return reduce(lambda a, b: a.bitwiseOR(b), [one(i) for i in range(bits)])


def segments_for(rows: int, bits: int) -> int:
    """The number of segments with the least expected work for ``rows`` evenly
    spread codes: every count of segments is priced by its lookups and by the
    codes these meet, up to the radius that covers the expected k-th distance.
    It decides the cost only; the answer is the same for any number."""
    far, tail = 0, 1
    while far < bits and rows * tail < K * 2 ** bits:
        far += 1
        tail += math.comb(bits, far)

    def work(m: int) -> float:
        width, radius = bits / m, -(-(far + 1) // m) - 1
        lookups = m * sum(math.comb(math.ceil(width), i) for i in range(radius + 1))
        return lookups * (LOOKUP_COST + rows / 2 ** width)

    return min(range(-(-bits // MAX_WIDTH), bits + 1), key=work)


def _cuts(bits: int, m: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments."""
    edge = [round(i * bits / m) for i in range(m + 1)]
    return [(edge[i], edge[i + 1] - edge[i]) for i in range(m)]


def _segment(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def topk(codes: DataFrame, queries: DataFrame, k: int = K, bits: int = 64) -> DataFrame:
    """``codes`` and ``queries``: ``(id, code BIGINT)``.  Returns ``(query_id,
    rank, neighbor_id, distance)``, rank from 1, the exact k nearest by
    (distance, id).  Equal codes are searched once; of each code the k smallest
    ids can be among any query's k nearest, so no more are kept."""
    from pyspark.sql import Window

    spark = codes.sparkSession
    first_k = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    rows = saved(codes.where(F.col("code").isNotNull()).select("id", "code").withColumn("nth", first_k)
                 .where(F.col("nth") <= k), "topk-rows")
    distinct = saved(rows.groupBy("code").agg(F.count(F.lit(1)).alias("n")), "topk-codes")
    asked = saved(queries.where(F.col("code").isNotNull()).groupBy("code").agg(F.count(F.lit(1)).alias("asking"))
                  .select(F.col("code").alias("q")), "topk-queries")
    n_codes = distinct.count()
    m = segments_for(n_codes, bits)
    cuts = _cuts(bits, m)
    post = lambda c: F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _segment(F.col(c), a, w).alias("val"))
                                         for i, (a, w) in enumerate(cuts)])).alias("at")
    index = saved(distinct.select("code", "n", post("code")).select("code", "n", "at.seg", "at.val"), "topk-index")
    widest = max(w for _, w in cuts)
    open_q = asked.withColumn("bound", F.lit(bits))
    parts: list[DataFrame] = []
    best = None
    for r in range(widest + 1):
        if open_q.isEmpty():
            break
        segs = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), F.lit(w).alias("width"))
                                   for i, (_, w) in enumerate(cuts)])).alias("s")
        shell = (spark.range(1 << widest).where(F.bit_count("id") == r).select(F.col("id").alias("flip"), segs)
                 .where(F.expr("flip < shiftleft(1L, s.width)"))
                 .select("s.seg", "flip"))  # values at distance r, at most 2^MAX_WIDTH a segment
        probes = (open_q.select("q", "bound", post("q")).select("q", "bound", "at.seg", "at.val")
                  .join(F.broadcast(shell), "seg")
                  .select("q", "bound", "seg", F.col("val").bitwiseXOR(F.col("flip")).alias("val")))
        far = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
        # A pair is taken where its first segment of this distance meets, so it appears once a round;
        # pairs beyond the bound of an earlier round cannot be among the k nearest.
        seen = (probes.join(index, ["seg", "val"]).where(far <= F.col("bound"))
                .select("q", "code", "n", far.alias("d")).distinct())
        parts.append(saved(seen, f"topk-round{r}"))
        found = reduce(DataFrame.unionByName, parts).distinct()
        # k-th distance by counting ids per distance: at most bits + 1 distances a query.
        levels = found.groupBy("q", "d").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("q").orderBy("d"))
        best = levels.withColumn("upto", upto).where(F.col("upto") >= k).groupBy("q").agg(F.min("d").alias("kth"))
        covered = m * (r + 1) - 1
        open_q = saved(open_q.select("q").join(best, "q", "left")
                       .where(F.col("kth").isNull() | (F.col("kth") > covered))
                       .select("q", F.coalesce("kth", F.lit(bits)).alias("bound")), f"topk-open{r}")
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, neighbor_id long, distance int")
    found = reduce(DataFrame.unionByName, parts).distinct()
    by_d = F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))
    answer = saved(found.join(rows.select("code", "id"), "code").withColumn("rank", by_d)
                   .where(F.col("rank") <= k).select("q", "rank", F.col("id").alias("neighbor_id"),
                                                     F.col("d").alias("distance")), "topk-answer")
    return (queries.select(F.col("id").alias("query_id"), F.col("code").alias("q"))
            .join(small(answer), "q").select("query_id", "rank", "neighbor_id", "distance"))


def vector_topk(vectors: DataFrame, k: int = K, bits: int = 64, every: int = 100, vec_id: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``, searched against all rows."""
    v = F.col(vector)
    code = F.when(F.size(v) > 0, sign_code(v, bits))
    rows = saved(vectors.select(F.col(vec_id).alias("id"), code.alias("code")).where("code IS NOT NULL"), "topk-signs")
    return topk(rows, rows.where(F.col("id") % every == 0), k, bits)


ORACLE = f"""
WITH c AS (SELECT vec_id, list_aggregate(list_transform(range(0, 64), lambda i: CASE WHEN embedding[i + 1] > 0
             THEN (1::HUGEINT << i::INT) ELSE 0::HUGEINT END), 'sum')::HUGEINT AS code
           FROM embeddings WHERE len(embedding) > 0),
pairs AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, bit_count(xor(q.code, r.code))::INT AS distance
          FROM c q, c r WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank FROM pairs)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= {K}
"""
