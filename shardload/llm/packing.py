"""Packing of token ids into sequences by best-fit decreasing.

Documents are tokenised whole and end with one end id.  Overlong ones are first
cut into full windows, each a sequence of its own; what remains of every
document goes to the tightest open window, longest pieces first.  Pieces of one
length are interchangeable, so the packing itself needs only the number of
pieces per length (at most ``size - 1`` numbers): a segment tree indexed by
remaining capacity finds the tightest open windows, and whole runs of equal
pieces and equal windows are placed at once.  The ranks that tie pieces to
places are counted where the pieces are made.

Defined results: a null text counts as empty and is its end id alone; repeated
rows are packed each for itself; pieces of one length are placed in the order of
input partitions, then rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardload.llm.common import BROADCAST_ROWS, saved, small
from shardload.llm.subwords import RunIds

SIZE, END_ID = 2048, 1
#: Bytes of ids handed on at once.
_BATCH_BYTES = 8 << 20


class CapacityTree:
    """Segment tree over capacities 0..size; a leaf is set while windows with that much room are open."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def mark(self, capacity: int, is_open: bool) -> None:
        k = capacity + self.leaves
        self.any[k] = is_open
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The smallest marked capacity that is at least ``need``."""
        k = need + self.leaves
        if self.any[k]:
            return need
        while k > 1 and not (k % 2 == 0 and self.any[k + 1]):
            k //= 2
        if k <= 1:
            return None
        k += 1
        while k < self.leaves:
            k = 2 * k if self.any[2 * k] else 2 * k + 1
        return k - self.leaves


def best_fit(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing for ``counts[length]`` pieces (lengths 1..size).

    Returns runs ``(length, first rank, last rank, first window, pieces per
    window, offset)`` and the number of windows: the piece with rank ``r`` of its
    length is in window ``first window + (r - first rank) // pieces per window``."""
    tree, room, runs, windows = CapacityTree(size), {}, [], 0

    def open_up(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            room.setdefault(capacity, []).append((first, n))
            tree.mark(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first, n = size, windows, -(-left // (size // length))
                windows += n
            else:
                first, n = room[capacity].pop()
                if not room[capacity]:
                    tree.mark(capacity, False)
            each = capacity // length  # the next equal piece finds the same window tightest
            whole = min(n, left // each)
            for k, per in ((whole, each), (int(whole < n and left - whole * each > 0), left - whole * each)):
                if k and per:
                    runs.append((length, rank, rank + k * per - 1, first, per, size - capacity))
                    rank, left = rank + k * per, left - k * per
                    open_up(capacity - per * length, first, k)
                    first, n = first + k, n - k
            open_up(capacity, first, n)
    return runs, windows


def tokenised(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``(doc_id, ids, n, task, full_before, rest, rest_rank)``: a document's ids as
    little-endian 32-bit numbers, how many full windows its task had before it,
    the length of its remaining piece and that piece's rank among the task's
    pieces of the length."""
    key = docs.schema[doc_id].dataType
    from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
    schema = StructType([StructField("doc_id", key), StructField("ids", BinaryType()), StructField("n", LongType()),
                         StructField("task", IntegerType()), StructField("full_before", LongType()),
                         StructField("rest", IntegerType()), StructField("rest_rank", LongType())])
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ranks, full, task = RunIds(tokenizer), Counter(), 0, TaskContext.get().partitionId()
        for batch in batches:
            a, held, cols = 0, 0, [[] for _ in range(5)]
            texts = batch.column(1).to_pylist()
            for i, t in enumerate(texts):
                ids = words.encode(t or "") + end
                n = len(ids) // 4
                for c, v in zip(cols, (ids, n, full, n % size, ranks[n % size])):
                    c.append(v)
                full += n // size
                ranks[n % size] += 1
                held += len(ids)
                if held >= _BATCH_BYTES or i + 1 == len(texts):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(a, i + 1 - a), pa.array(cols[0], pa.binary()),
                        pa.array(cols[1], pa.int64()), pa.array([task] * len(cols[0]), pa.int32()),
                        pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                        pa.array(cols[4], pa.int64())], schema.names)
                    a, held, cols = i + 1, 0, [[] for _ in range(5)]

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids, doc_tokens, sequence_id,
    offset)``; ``ids`` are little-endian 32-bit numbers.  ``tokenizer`` is the
    path of the tokenizer file on every machine."""
    spark = docs.sparkSession
    tokens = saved(tokenised(docs, tokenizer, size, end_id, doc_id, text), "tokens")
    per_task = saved(tokens.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("k"),
                                                        F.sum(F.floor(F.col("n") / size)).alias("full")), "tokens-tasks")
    counts = {r.rest: r.k for r in per_task.where("rest > 0").groupBy("rest").agg(F.sum("k").alias("k")).collect()}
    runs, windows = best_fit(counts, size)

    before = F.coalesce(F.sum("k").over(Window.partitionBy("rest").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    tasks = per_task.groupBy("task").agg(F.sum("full").alias("full")).select(  # one row a task
        "task", F.coalesce(F.sum("full").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("task_full"))
    bases = per_task.select("task", "rest", before.alias("base")).join(F.broadcast(tasks), "task")
    bases = small(saved(bases, "tokens-bases"), BROADCAST_ROWS)
    places = spark.createDataFrame(runs, "rest int, lo long, hi long, first long, per int, at int")
    if len(runs) <= BROADCAST_ROWS:
        places = F.broadcast(places)

    d = tokens.join(bases, ["task", "rest"]).withColumn("rank", F.col("base") + F.col("rest_rank"))
    d = d.join(places, (d["rest"] == places["rest"]) & F.col("rank").between(F.col("lo"), F.col("hi")), "left").select(
        "doc_id", "ids", "n", d["rest"].alias("rest"), (F.lit(windows) + F.col("task_full") + F.col("full_before")).alias("w"),
        (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).alias("window"),
        (F.col("at") + (F.col("rank") - F.col("lo")) % F.col("per") * d["rest"]).alias("offset"))
    # The ids are cut inside the row, so a long document is not copied once per piece.
    full = F.expr(f"transform(sequence(0L, n div {size}), i -> struct(i * {size} as start, "
                  f"cast(if(i < n div {size}, {size}, rest) as long) as length, "
                  f"substring(ids, cast(4 * i * {size} + 1 as int), if(i < n div {size}, 4 * {size}, 4 * rest)) as ids, "
                  f"if(i < n div {size}, w + i, window) as sequence_id, "
                  f"cast(if(i < n div {size}, 0, offset) as long) as offset))")
    return (d.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(full).alias("p"))
            .where(F.col("p.length") > 0)
            .select("doc_id", "p.start", "p.length", "p.ids", "doc_tokens", "p.sequence_id", "p.offset"))
