"""Shard routing and placement.

One exchange in the whole build: ``by_shard`` places the thin keyed lines
before they are parsed, each in the partition of its shard
(``repartitionById``: the partition id *is* the shard, no second hash).  Shards
too big for one task are cut into ``split`` ranges of ids.
"""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardload.functions.routing_hash import murmur3_id, shard_of


def route(docs: DataFrame, shards: int, id_col: str = "_id") -> DataFrame:
    """``shard_id = pmod(murmur3_utf16(_id), shards)``."""
    return docs.withColumn("shard_id", shard_of(id_col, shards))


def route_hash(docs: DataFrame, id_col: str = "_id") -> DataFrame:
    return docs.withColumn("hash", murmur3_id(F.col(id_col)))


BYTES_PER_PLACEMENT_TASK = 512 << 20


def auto_split(input_bytes: int, shards: int, bytes_per_task: int = BYTES_PER_PLACEMENT_TASK) -> int:
    """Sub-partitions per shard so that a placement task receives about
    ``bytes_per_task`` of input text.  The order of a shard does not depend on it."""
    return max(1, -(-input_bytes // max(1, shards * bytes_per_task)))


def java_order_key(c) -> F.Column:
    """Sort key with Java's ``String.compareTo`` order: unsigned comparison of
    UTF-16 code units equals byte order of the UTF-16BE encoding (plain UTF-8
    order differs once supplementary characters meet high BMP characters)."""
    return F.encode(c, "UTF-16BE")


def by_shard(docs: DataFrame, shards: int, split: int = 1) -> DataFrame:
    """the one exchange.  ``split=1``: partition ``p`` is shard ``p``.
    Otherwise ``shards * split`` ranges of (shard, id, document key): the files
    of a shard follow one another in order, and an id of any size is split by
    the document key."""
    if split <= 1:
        return docs.repartitionById(shards, F.col("shard_id"))
    return docs.repartitionByRange(shards * split, F.col("shard_id"), java_order_key(F.col("_id")).desc(), F.col("_doc"))


#: Rows of the sketch for each range: a range's bytes are met to about one part in the square root of it.
SKETCH = 64


def byte_sketch(docs: DataFrame, size: Column, range_bytes: int) -> DataFrame:
    """``(shard_id, _id, _doc, weight)``: a sample of the rows by their bytes, of about ``SKETCH`` rows for every
    ``range_bytes``.  A row of that share or more is in it with its own bytes; a smaller one with a chance in proportion to
    its bytes, standing for the whole share.  The draw hashes the row's keys, so a retried task draws the same."""
    share = max(1, range_bytes // SKETCH)
    chance = F.pmod(F.xxhash64("_doc", "_id"), F.lit(1 << 30)) * (share / (1 << 30))
    return (docs.select("shard_id", "_id", "_doc", size.cast("long").alias("b")).where((F.col("b") >= share) | (F.col("b") > chance))
            .select("shard_id", "_id", "_doc", F.greatest("b", F.lit(share)).alias("weight")))


def range_bounds(docs: DataFrame, size: Column, range_bytes: int) -> dict[int, list[tuple]]:
    """Per shard the first document ``(_id, _doc)`` of every range but the first, in the order of the shard: weighted
    quantiles of the sketch, about ``range_bytes`` apart.  A shard has as many as its bytes ask for."""
    order = [java_order_key(F.col("_id")).desc(), F.col("_doc")]
    upto = Window.partitionBy("shard_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # over the sketch alone
    at = F.floor(F.col("before") / range_bytes)
    rows = byte_sketch(docs, size, range_bytes).withColumn("before", F.coalesce(F.sum("weight").over(upto), F.lit(0)))
    first = Window.partitionBy("shard_id").orderBy(*order)
    cut = rows.withColumn("at", at).withColumn("previous", F.lag("at").over(first)).where("at > previous")
    bounds: dict[int, list[tuple]] = {}
    for r in cut.orderBy("shard_id", "before").collect():  # a row for each range
        bounds.setdefault(r["shard_id"], []).append((r["_id"], r["_doc"]))
    return bounds


def by_bytes(docs: DataFrame, shards: int, size: Column, range_bytes: int = BYTES_PER_PLACEMENT_TASK) -> DataFrame:
    """F2 by weight: every shard is cut into ranges of about ``range_bytes`` (of ``size``), so a shard of long lines gets
    more tasks than one of short lines.  One exchange of the rows, after a pass over their keys and sizes; the files of a
    shard follow one another in order, and an id of any size is split by the document key."""
    bounds = range_bounds(docs, size, range_bytes)
    first, total = {}, 0
    for shard in range(shards):
        first[shard] = total
        total += 1 + len(bounds.get(shard, ()))
    # Of each shard the bounds' ids, ascending, and of each such id the document keys of its bounds.
    ids = {s: [i.encode("utf-16-be", "surrogatepass") for i, _ in reversed(b)] for s, b in bounds.items()}
    keys: dict[tuple, list] = {}
    for s, own in bounds.items():
        for i, d in own:
            keys.setdefault((s, i), []).append(d)

    def place(shard: pd.Series, doc_id: pd.Series, doc: pd.Series) -> pd.Series:
        out = []
        for s, i, d in zip(shard, doc_id, doc):
            own = ids.get(s)
            if own is None:
                out.append(first[s])
                continue
            key = i.encode("utf-16-be", "surrogatepass")
            out.append(first[s] + len(own) - bisect_right(own, key) + bisect_right(keys.get((s, i), ()), d))
        return pd.Series(out, dtype="int32")

    placed = F.pandas_udf(place, "int")("shard_id", "_id", "_doc")
    return docs.withColumn("_range", placed).repartitionById(total, F.col("_range")).drop("_range")


def order_shard(docs: DataFrame) -> DataFrame:
    """inside each shard, documents in descending id order, equal ids in
    document order.  The leading ``shard_id`` keeps the order through a
    partitioned write."""
    tie = [F.col("_doc")] if "_doc" in docs.columns else []
    return docs.sortWithinPartitions(F.col("shard_id"), java_order_key(F.col("_id")).desc(), *tie)


def shard_histogram(docs: DataFrame) -> DataFrame:
    return docs.groupBy("shard_id").agg(F.count(F.lit(1)).alias("n_docs"))


def shard_skew(docs: DataFrame) -> DataFrame:
    """one row — shard count, largest/smallest/mean shard and max/mean."""
    h = shard_histogram(docs)
    return h.agg(F.count(F.lit(1)).alias("n_shards"),
                 F.max("n_docs").alias("max_docs"),
                 F.min("n_docs").alias("min_docs"),
                 F.sum("n_docs").alias("total_docs"),
                 F.round(F.max("n_docs") / F.avg("n_docs"), 6).alias("skew"))
