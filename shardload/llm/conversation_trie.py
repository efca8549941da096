"""Prefix trie of conversations, from union-find over sorted neighbours.

Conversations that are equal turn by turn become one path with a number of copies.
The paths are sorted over range partitions; the longest common prefix (LCP) of two
neighbours is an edge.  Inside a partition the edges are taken in descending depth:
each merge of components makes or widens a branching node, and a component that
merges higher up is closed and its nodes are final.  What touches the first or the
last path of a partition stays open.  Closed subtrees are contracted to sums in the
open nodes above them, and the open nodes of all partitions are merged by prefix.

A prefix is known by 128 bits: the exclusive or of a hash of every turn and its
place.  Sums need no second pass over a subtree: a merge at depth ``d`` saves
the characters of the first ``d`` turns once, whatever lies below.

Nothing is gathered by conversation but hashes of the turns that another, different
conversation begins with as well: positions, prefixes and characters are running
values over range partitions, and turns that only one path has are nodes as they are.

Defined results: rows without a conversation id belong to none; a null role or text
is empty; turns of equal number are in the order of their hash, repeated rows are turns
of their own; a conversation without turns of its own or its base's ends at the root;
an empty table has no root; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardload.llm.common import saved, small

#: A conversation takes its first turns from the first of its hundred, how many its own hash says.
GROUP, HEADS = 100, 6
#: Ids joined to one text before a digest; rows handed on at once.
CHUNK, ROWS = 256, 20_000

NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def running(df: DataFrame, key: str, order: str, xors: tuple[str, ...] = (), sums: tuple[str, ...] = ()) -> DataFrame:
    """``df`` sorted by (``key``, ``order``, …) with ``n`` (rows of the key so far) and the columns of ``xors``
    and ``sums`` (BIGINT) replaced by their running values inside the key, this row included.

    Rows are dealt by range, so one key of any size is cut over many tasks.  What a key had in the
    partitions before is added after: at most one key of a partition comes from an earlier one."""
    names, values = df.columns, [*xors, *sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carry = TaskContext.get().partitionId(), None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(names.index(key)).to_numpy()
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(k)]))
            goes_on = last is not None and k[0] == last
            own, new = {c: batch.column(i) for i, c in enumerate(names)}, {}
            for c in ["n", *values]:
                v = np.ones(len(k), np.int64) if c == "n" else own[c].to_numpy()
                total = np.bitwise_xor.accumulate(v) if c in xors else np.cumsum(v)
                before = np.r_[0, total][starts][group]
                total = total ^ before if c in xors else total - before
                if goes_on:
                    mine = group == 0
                    total[mine] = total[mine] ^ carry[c] if c in xors else total[mine] + carry[c]
                new[c], carry[c] = total, total[-1]
            last = k[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[c]) if c in new else own[c] for c in [*names, "n"]] + [pa.array(np.full(len(k), part, np.int32))],
                [*names, "n", "_p"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", n long, _p int"
    rows = saved(df.repartitionByRange(key, order).sortWithinPartitions(key, order).mapInArrow(run, schema), "trie-running")
    # Keys that begin a partition: as many as tasks; of each, a row for each partition that it is in.
    begins = rows.groupBy("_p").agg(F.min(key).alias(key)).select(key).distinct()
    whole = rows.join(F.broadcast(begins), key).groupBy(key, "_p").agg(
        F.max("n").alias("n"), *[F.max_by(c, "n").alias(c) for c in values])
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    had = whole.select(key, "_p", *[(F.bit_xor(c) if c in xors else F.sum(c)).over(before).alias(f"had_{c}") for c in ["n", *values]])
    rows = rows.join(F.broadcast(saved(had.where("had_n > 0"), "trie-carry")), [key, "_p"], "left")

    def with_carry(c: str) -> Column:
        had = F.coalesce(f"had_{c}", F.lit(0))
        return (F.col(c).bitwiseXOR(had) if c in xors else F.col(c) + had).alias(c)

    return rows.select(*[with_carry(c) if c in values else F.col(c) for c in names], with_carry("n"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(c, depth, f1, f2, cum, w)``: every turn of every rebuilt conversation with its prefix, the characters
    up to it and its own; and ``(c)``, all conversations."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text"))
    thin = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("c"), F.length(text("text")).cast("long").alias("w"),
                    F.struct(F.col("turn").alias("t"), F.substring(F.sha2(turn, 256), 1, 32).alias("h")).alias("o")))
    own = saved(running(thin, "c", "o"), "trie-turns").select("c", "w", F.col("o.h").alias("h"), "n")
    convs = saved(own.groupBy("c").agg(F.max("n").alias("size")).withColumns({
        "base": F.col("c") - F.col("c") % GROUP, "head": F.crc32(F.col("c").cast("string").cast("binary")) % HEADS}), "trie-convs")
    bases = convs.select(F.col("c").alias("base"), F.col("size").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("head", F.coalesce("there", F.lit(0))))
    # A base has at most HEADS - 1 turns to give, and at most twice GROUP conversations take them.
    heads = convs.select("c", "base", "taken").join(
        own.where(F.col("n") < HEADS).withColumnRenamed("c", "base"), "base").where(F.col("n") <= F.col("taken"))
    tails = own.join(convs.select("c", "head", "taken"), "c").where(F.col("n") > F.col("head"))
    rows = heads.select("c", F.col("n").alias("depth"), "h", "w").unionByName(
        tails.select("c", (F.col("n") - F.col("head") + F.col("taken")).alias("depth"), "h", "w"))
    rows = rows.select("c", "depth", F.xxhash64("h", "depth").alias("f1"), F.xxhash64("depth", F.lit("second"), "h").alias("f2"),
                       F.col("w").alias("cum"), "w")
    return saved(running(rows, "c", "depth", ("f1", "f2"), ("cum",)).drop("n"), "trie-prefixes"), convs.select("c")


FOREST = ("kind int, p int, conv long, depth long, n long, children long, leaves long, saved long, ends long, parent long, "
          "pdepth long, pf1 long, pf2 long, f1 long, f2 long, is_first boolean, is_last boolean, above long, upto long")
CLOSED, OPEN, TAIL = 0, 1, 2
_FIELDS = [f.split()[0] for f in FOREST.split(", ")]
_TYPES = [{"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}[f.split()[1]] for f in FOREST.split(", ")]


class Forest:
    """Union-find over the sorted paths of one partition.  A component is an interval of paths, kept at its first one."""

    def __init__(self, rep, n, length, total, leaf, edge, f1, f2, cum):
        self.rep, self.length, self.edge, self.f1, self.f2, self.cum = rep, length, edge, f1, f2, cum
        self.shared = np.diff(edge)  # turns of a path that others share
        m = len(rep)
        self.up, self.end = list(range(m)), list(range(m))
        self.least, self.count, self.leaves = rep.tolist(), n.tolist(), leaf.tolist()
        self.saving = ((n - 1) * total).tolist()
        self.bottom, self.children, self.ends = length.tolist(), [0] * m, [None] * m
        self.rows: list[tuple] = []

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def lcps(self) -> np.ndarray:
        """Shared turns of every path and the next: prefixes are told by the last turn, so by bisection."""
        a, b = self.edge[:-2], self.edge[1:-1]
        low, high = np.zeros(len(a), np.int64), np.minimum(self.shared[:-1], self.shared[1:])
        while (low < high).any():
            mid = (low + high + 1) // 2
            at = np.where(mid > 0, mid - 1, 0)
            x, y = np.minimum(a + at, len(self.f1) - 1), np.minimum(b + at, len(self.f1) - 1)
            same = (mid > low) & (self.f1[x] == self.f1[y]) & (self.f2[x] == self.f2[y])
            low, high = np.where(same, mid, low), np.where(same, high, np.maximum(low, mid - 1))
        return low

    def upto(self, i: int, depth: int) -> int:
        """Characters of the first ``depth`` turns of path ``i``."""
        return int(self.cum[self.edge[i] + depth - 1]) if depth else 0

    def prefix(self, i: int, depth: int) -> tuple:
        at = self.edge[i] + depth - 1
        return (int(self.f1[at]), int(self.f2[at])) if depth else (0, 0)

    def state(self, i: int) -> tuple:
        return self.bottom[i], self.least[i], self.count[i], self.leaves[i], self.saving[i], self.children[i], self.ends[i]

    def run(self) -> None:
        m = len(self.rep)
        last = m - 1
        #: Of the first and of the last path: what its component was from which depth up.
        history: dict[int, list] = {i: [(int(self.shared[i]), *self.state(i)[1:5], int(self.length[i] > self.shared[i]),
                                         int(self.rep[i]) if self.length[i] == self.shared[i] else None)] for i in {0, last}}
        lcp = self.lcps() if m > 1 else np.zeros(0, np.int64)
        order = np.argsort(-lcp, kind="stable")
        a = 0
        while a < len(order):
            depth = int(lcp[order[a]])
            b = a + int(np.searchsorted(-lcp[order[a:]], -depth, "right"))
            self.level(depth, order[a:b].tolist(), last, history)
            a = b
        for i in (0, last)[:1 + (m > 1)]:  # tails of the outermost paths hang on open nodes
            if self.length[i] > self.shared[i]:
                self.tail(i, int(self.shared[i]), None, i)
        self.spines(last, history, int(lcp.min()) if m > 1 else None)

    def level(self, depth: int, edges: list[int], last: int, history: dict) -> None:
        """All merges at ``depth``: what merges is a child of the node made here, or ends here."""
        met: dict[int, list] = {}
        for i in edges:
            a, b = self.find(i), self.find(i + 1)
            left, right = met.pop(a, None) or [(a, self.end[a], self.state(a))], met.pop(b, None) or [(b, self.end[b], self.state(b))]
            left.extend(right)
            self.up[b], self.end[a] = a, self.end[b]
            self.least[a] = min(self.least[a], self.least[b])
            self.count[a] += self.count[b]
            self.leaves[a] += self.leaves[b]
            self.saving[a] += self.saving[b] + self.upto(i, depth)
            met[a] = left
        for a, parts in met.items():
            is_open = a == 0 or self.end[a] == last
            closed, ends = 0, None
            for lo, hi, state in parts:
                if lo == hi and self.length[lo] == depth:
                    ends = int(self.rep[lo])
                    continue
                outer = lo == 0 or hi == last
                # the component of an outermost path goes on as an open node, unless only its tail lies below
                closed += not outer or all(depth >= self.shared[i] for i in (0, last) if lo <= i <= hi)
                if outer:
                    continue
                if lo == hi:
                    self.tail(lo, depth, None if is_open else self.least[a], a)
                else:
                    self.close(lo, depth, state, None if is_open else self.least[a])
            self.bottom[a], self.children[a], self.ends[a] = depth, closed, ends
            for i in {0, last}:
                if a <= i <= self.end[a]:
                    history[i].append((depth, *self.state(a)[1:]))

    def row(self, **values) -> None:
        self.rows.append(tuple(map(values.get, _FIELDS)))

    def parent(self, i: int, depth: int, known: int | None) -> dict:
        """The node of path ``i`` at ``depth``: its least conversation, or its prefix if that is open."""
        if known is not None:
            return {"parent": known}
        f1, f2 = self.prefix(i, depth)
        return {"pdepth": depth, "pf1": f1, "pf2": f2}

    def tail(self, i: int, depth: int, known: int | None, at: int) -> None:
        self.row(kind=TAIL, conv=int(self.rep[i]), depth=depth + 1, **self.parent(i, depth, known))

    def close(self, i: int, depth: int, state: tuple, known: int | None) -> None:
        """The nodes of a component from below ``depth`` down to where it branches."""
        bottom, least, count, leaves, saving, children, ends = state
        for d in range(depth + 1, bottom + 1):
            lowest = d == bottom
            self.row(kind=CLOSED, conv=least, depth=d, n=count, children=children if lowest else 1, leaves=leaves,
                     saved=saving - (count - 1) * self.upto(i, d - 1), ends=ends if lowest else None,
                     **(self.parent(i, depth, known) if d == depth + 1 else {"parent": least}))

    def spines(self, last: int, history: dict, common: int | None) -> None:
        """Open nodes: every prefix of the first and of the last path, with what this partition has of them."""
        for i in (0, last)[:1 + (last > 0)]:
            steps = history[i]
            k = len(steps) - 1
            for d in range(0 if i == 0 else (common or 0) + 1, int(self.shared[i]) + 1):
                while k > 0 and steps[k][0] < d:
                    k -= 1
                depth, least, count, leaves, saving, children, ends = steps[k]
                f1, f2 = self.prefix(i, d)
                above = self.prefix(i, d - 1) if d else (None, None)
                self.row(kind=OPEN, conv=least, depth=d, n=count, children=children if depth == d else 0, leaves=leaves, saved=saving,
                         ends=ends if depth == d else None, f1=f1, f2=f2, pf1=above[0], pf2=above[1],
                         is_first=i == 0, is_last=i == last or common is not None and d <= common,
                         above=self.upto(i, d - 1) if d else 0, upto=self.upto(i, d))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of the paths of a partition, a share of the table that range partitioning bounds."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    numbers = [table[c].to_numpy() for c in ("rep", "copies", "length", "total", "leaf")]
    path = table["path"].combine_chunks()
    path = path.chunk(0) if isinstance(path, pa.ChunkedArray) else path
    edge = np.r_[0, np.cumsum(path.value_lengths().to_numpy())].astype(np.int64)
    turns = [c.to_numpy() for c in path.flatten().flatten()]
    forest = Forest(*numbers, edge, *turns)
    forest.run()
    part = TaskContext.get().partitionId()
    for a in range(0, len(forest.rows), ROWS):
        columns = list(zip(*forest.rows[a:a + ROWS]))
        columns[1] = [part] * len(columns[0])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _FIELDS)


def _digests(members: DataFrame) -> DataFrame:
    """``(rep, sha)``: the hash of the ids of each class in ascending order, comma-joined.  Ids are written out side by
    side, some hundreds to a row; the hash, which takes them one after another, streams those rows."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, c = (batch.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero(np.r_[True, rep[1:] != rep[:-1]]) if len(rep) else []
            cuts = [(k, min(k + CHUNK, b)) for a, b in zip(starts, [*starts[1:], len(rep)]) for k in range(a, b, CHUNK)]
            yield pa.RecordBatch.from_arrays([
                pa.array([rep[a] for a, _ in cuts], pa.int64()), pa.array([c[a] for a, _ in cuts], pa.int64()),
                pa.array([",".join(map(str, c[a:b].tolist())) for a, b in cuts], pa.string())], ["rep", "c", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        out = lambda k, s: pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.string())], ["rep", "sha"])
        for batch in batches:
            keys, digests = [], []
            for rep, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if rep == last:
                    sha.update(b",")
                else:
                    if sha is not None:
                        keys.append(last)
                        digests.append(sha.hexdigest())
                    last, sha = rep, hashlib.sha256()
                sha.update(ids.encode())
            yield out(keys, digests)
        if sha is not None:
            yield out([last], [sha.hexdigest()])

    chunks = members.repartitionByRange("rep", "c").sortWithinPartitions("rep", "c").mapInArrow(texts, "rep long, c long, ids string")
    return chunks.repartition("rep").sortWithinPartitions("rep", "c").select("rep", "ids").mapInArrow(hashed, "rep long, sha string")


def _merged(forest: DataFrame) -> DataFrame:
    """Open nodes of all partitions, merged by prefix.  Where a node goes on into the next partition, the
    common prefix of the paths on both sides of the boundary is a merge like any other."""
    spark = forest.sparkSession
    pieces = forest.where(F.col("kind") == OPEN)
    parts = sorted(r.p for r in pieces.select("p").distinct().collect())  # as many as tasks
    after = spark.createDataFrame(list(zip(parts, parts[1:])), "p int, q int")
    at = ["depth", "f1", "f2"]
    starts = pieces.where("is_first").select(F.col("p").alias("q"), *at)
    ends = pieces.where("is_last").join(F.broadcast(after), "p").select("q", *at, "upto")
    boundary = (starts.join(ends, ["q", *at]).groupBy("q").agg(F.max(F.struct("depth", "upto")).alias("x"))
                .select("q", F.col("x.depth").alias("lcp"), F.col("x.upto").alias("saved")))  # a row for each boundary
    added = starts.join(F.broadcast(saved(boundary, "trie-boundaries")), "q").where(F.col("depth") <= F.col("lcp")).select(*at, "saved")
    nodes = pieces.unionByName(added, allowMissingColumns=True).groupBy(*at).agg(
        F.min("conv").alias("conv"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves")], *[F.max(c).alias(c) for c in ("pf1", "pf2", "above")])
    return saved(nodes, "trie-open")


def nodes(conversations: DataFrame) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` of every node."""
    turns, convs = rebuilt(conversations)
    zero = F.lit(0).cast("long")
    path = F.struct("depth", "f1", "f2", "cum")
    ends = (turns.select("c", path.alias("x")).unionByName(convs.select("c", F.struct(*[zero.alias(c) for c in ("depth", "f1", "f2", "cum")]).alias("x")))
            .groupBy("c").agg(F.max("x").alias("x")).select("c", F.col("x.depth").alias("length"), "x.f1", "x.f2", F.col("x.cum").alias("total")))
    ends = saved(ends, "trie-ends")
    same = ["length", "f1", "f2"]
    classes = saved(ends.groupBy(*same).agg(F.min("c").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("total").alias("total")), "trie-classes")
    reps = classes.select("rep", "copies", "length", "total")
    own = saved(turns.withColumnRenamed("c", "rep").join(reps, "rep"), "trie-paths")
    at = ["depth", "f1", "f2"]
    shared = own.groupBy(*at).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(*at, F.lit(True).alias("shared"))
    shared = saved(shared, "trie-prefixes-shared")  # read back, so that both sides of the join are plain and a hot prefix is split
    own = saved(own.join(shared, at, "left").withColumn("shared", F.coalesce("shared", F.lit(False))), "trie-shared")
    paths = own.where("shared").groupBy("rep").agg(F.sort_array(F.collect_list(path)).alias("path"))
    paths = reps.join(paths, "rep", "left").withColumn("path", F.transform(
        F.coalesce("path", F.array().cast(paths.schema["path"].dataType)),
        lambda x: F.struct(x["f1"].alias("f1"), x["f2"].alias("f2"), x["cum"].alias("cum"))))
    alone = reps.limit(2).count() == 1  # a single path has no extension, however short
    paths = paths.withColumn("leaf", ((F.col("length") > F.size("path")) | F.lit(alone)).cast("long"))
    forest = saved(paths.select("rep", "copies", "length", "total", "leaf", "path").repartitionByRange("path", "rep")
                   .sortWithinPartitions("path", "rep").mapInArrow(_forest, FOREST), "trie-forest")
    merged = _merged(forest)
    root = merged.where("depth = 0").select("conv").first()
    root = F.lit(root.conv if root else None).cast("long")

    # Open nodes: children are the closed ones and the open nodes one deeper; parents are open as well.
    upper = merged.select(F.col("depth").alias("pdepth"), F.col("f1").alias("pf1"), F.col("f2").alias("pf2"), F.col("conv").alias("found"))
    ref = ["pdepth", "pf1", "pf2"]
    below = merged.where("depth > 0").withColumn("pdepth", F.col("depth") - 1)
    more = below.groupBy(*ref).agg(F.count(F.lit(1)).alias("opened"))
    more = more.select(F.col("pdepth").alias("depth"), F.col("pf1").alias("f1"), F.col("pf2").alias("f2"), "opened")
    open_nodes = (merged.withColumn("pdepth", F.col("depth") - 1).join(more, at, "left").join(upper, ref, "left")
                  .select(F.col("conv").alias("conv_id"), "depth", F.col("found").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                          (F.col("children") + F.coalesce("opened", F.lit(0))).alias("n_children"), F.col("leaves").alias("n_leaves"),
                          (F.col("saved") - (F.col("n") - 1) * F.col("above")).alias("saved_tokens"), "ends"))

    # Closed nodes and tails whose parent is open are told by its prefix; the root needs no look-up.
    hung = forest.where(F.col("kind") != OPEN).withColumn("parent", F.coalesce("parent", F.when(F.col("pdepth") == 0, root)))
    columns = ["kind", "conv", "depth", "n", "children", "leaves", "saved", "ends", "parent"]
    found = hung.where("parent IS NULL").drop("parent").join(small(upper), ref).withColumnRenamed("found", "parent")
    hung = hung.where("parent IS NOT NULL").select(*columns).unionByName(found.select(*columns))
    closed = hung.where(F.col("kind") == CLOSED).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends")

    # Turns that one path alone has are nodes: its first one hangs where the path leaves the others.
    first = hung.where(F.col("kind") == TAIL).select(F.col("conv").alias("rep"), "depth", "parent")
    last = F.col("depth") == F.col("length")
    tails = own.where(~F.col("shared")).join(first, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"), "depth", F.coalesce("parent", "rep").alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("copies") - 1) * (F.col("total") - F.col("cum") + F.col("w"))).alias("saved_tokens"), F.when(last, F.col("rep")).alias("ends"))

    rows = open_nodes.unionByName(closed).unionByName(tails)
    copied = classes.where("copies > 1").select(*same, "rep")
    digests = saved(_digests(ends.join(copied, same).select("rep", "c")), "trie-digests")
    rows = rows.join(small(digests.withColumnRenamed("rep", "ends")), "ends", "left").withColumn(
        "ends_sha256", F.when(F.col("ends").isNull(), hashlib.sha256(b"").hexdigest()).otherwise(
            F.coalesce("sha", F.sha2(F.col("ends").cast("string"), 256))))
    return rows.select(*NODE)


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: unicode(substr(c::VARCHAR, i, 1))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

ORACLE = f"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % {GROUP} AS base, {_CRC} % {HEADS} AS head FROM (SELECT DISTINCT c FROM o)),
r AS (SELECT ids.c, o.n, 0 AS own, role, text FROM ids JOIN o ON o.c = ids.base AND o.n <= ids.head
      UNION ALL SELECT o.c, o.n, 1 AS own, role, text FROM o JOIN ids ON o.c = ids.c AND o.n > ids.head),
t AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, n) AS d, role, text FROM r),
p AS MATERIALIZED (SELECT c, d, list([role, text]) OVER (PARTITION BY c ORDER BY d) AS key, length(text) AS w FROM t
      UNION ALL SELECT c, 0, [], 0 FROM ids),
nodes AS MATERIALIZED (SELECT d, key, min(c) AS conv, count(*) AS n, min(w) AS w FROM p GROUP BY d, key),
m AS MATERIALIZED (SELECT p.c, p.d, nodes.conv FROM p JOIN nodes USING (d, key)),
up AS (SELECT nodes.conv, nodes.d, nodes.n, nodes.w, m.conv AS parent FROM nodes LEFT JOIN m ON m.c = nodes.conv AND m.d = nodes.d - 1),
kids AS (SELECT parent AS conv, d - 1 AS d, count(*) AS k FROM up WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT up.*, coalesce(k, 0) AS k FROM up LEFT JOIN kids USING (conv, d)),
sub AS (SELECT m.conv, m.d, count(*) FILTER (WHERE x.k = 0) AS leaves, sum((x.n - 1) * x.w) AS saved
        FROM full_nodes x JOIN m ON m.c = x.conv AND m.d <= x.d GROUP BY m.conv, m.d),
ends AS (SELECT m.conv, m.d, string_agg(m.c::VARCHAR, ',' ORDER BY m.c) AS ids
         FROM m JOIN (SELECT c, max(d) AS d FROM p GROUP BY c) l ON l.c = m.c AND l.d = m.d GROUP BY m.conv, m.d)
SELECT f.conv AS conv_id, CAST(f.d AS BIGINT) AS depth, parent AS parent_conv_id, f.n AS n_convs, f.k AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes f JOIN sub USING (conv, d) LEFT JOIN ends USING (conv, d)
"""
