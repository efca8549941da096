"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.session import scratch_path

#: Rows up to which a side may be broadcast (a few columns of fixed width).
BROADCAST_ROWS = 500_000
#: Rows of one key beyond which ``spread_join`` may take it for hot.
PLACE_ROWS = 256
#: Rows of an Arrow batch whose texts are Python objects at once.
SLICE_ROWS = 512


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, a few at a time: what a worker makes of a batch's texts, and keeps of the
    memory for its next task, does not grow with the batch."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(a, SLICE_ROWS)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, so a lost executor costs one read, and later uses share one result."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (already saved) with a broadcast hint if it has at most ``limit``
    rows; a larger one is left to an ordinary (skew-split) shuffle join."""
    return F.broadcast(df) if df.count() <= limit else df


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, thin: bool = False) -> DataFrame:
    """Inner join of ``many`` (saved) with ``one``, which has at most a row for each ``key``, so that a hot key is no
    single task's work.  A key is hot if it has more rows in ``many`` than PLACE_ROWS, and than a share that at most
    BROADCAST_ROWS keys can have.  The row of a hot key is sent to all tasks if ``one`` is ``thin`` (a few columns of fixed
    width), else laid out in several places, to which the key's rows are dealt by a hash of column ``by``."""
    least = max(PLACE_ROWS, -(-many.count() // BROADCAST_ROWS))
    hot = (many.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > least)
           .select(key, F.ceil(F.col("__n") / least).cast("int").alias("__places")))
    hot = saved(hot, "hot-keys")
    if hot.isEmpty():
        return many.join(one, key)
    hot = F.broadcast(hot)
    rest = many.join(hot, key, "left_anti").join(one, key)
    if thin:
        laid = saved(one.join(hot, key).drop("__places"), "hot-rows")
        return rest.unionByName(many.join(F.broadcast(laid), key))
    dealt = many.join(hot, key).withColumn("__place", F.pmod(F.xxhash64(by), F.col("__places")).cast("int")).drop("__places")
    laid = one.join(hot, key).withColumn("__place", F.explode(F.sequence(F.lit(0), F.col("__places") - 1))).drop("__places")
    return rest.unionByName(dealt.join(laid, [key, "__place"]).drop("__place"))


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character unchanged; null becomes ''."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def share(key: Column, fraction: float) -> Column:
    """True for about ``fraction`` of the rows, decided by a hash of ``key`` alone."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(fraction * (1 << 30))
