"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardload.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges(a BIGINT, b BIGINT)`` -> ``(node, root)``: every node of an edge
    and the smallest node of its component.

    Each step points larger neighbours at a node's smallest one (large star),
    then smaller ones (small star); the number of steps grows with the logarithm
    of the component size.  Every step is written to the shared folder."""
    lesser, greater = F.least("a", "b"), F.greatest("a", "b")
    e = saved(edges.where("a <> b").select(greater.alias("u"), lesser.alias("v")).distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        e = saved(small, "edges")
        state = tuple(e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
