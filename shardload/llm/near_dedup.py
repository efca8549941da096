"""Near-duplicate groups: a signature-coordinate inverted join over MinHash.

A document's set are its distinct five-word shingles.  Documents with equal sets
form a class; the rest works on one member a class.  Each class is posted under
its signature's coordinate-value pairs.  Two classes above the similarity agree
on at least ``needed`` of the ``COORDINATES`` (but for a chance of about one in
a million at the threshold itself), so values that no other class has are
skipped, and of the others only a prefix is posted, rarest first: it must share
a pair with the partner's prefix.  Candidates then count their collisions;
those with enough are compared by their full sets.

Posting lists are not expanded into all pairs of rows.  Every list has a pivot
(the member with the most shared values); all members of all lists of a pivot
are compared with it, and what is linked with it is connected.  Only members
that are not linked with it still have to be compared, with each other and with
the linked ones.  Few of them are compared inside a task, where
pairs that are already connected are skipped and at most one link a member is
handed on.  Of many, those can be similar that share one of their rarest shingles, as many
as the threshold leaves open: they are posted under these, and the shorter lists are worked
off in the same way, with pivots of their own (``DEPTH`` times; what is still left then is compared in
blocks of bounded size).  Pages of one template, far below the threshold, share no rare shingle.
No link that joins two groups is lost; a list of copies costs its length.

Defined results: A-Z are lower-cased and words end at white space; fewer than
five words are one shingle; a null text or one without words has an empty set
and is linked with nothing; ids are read as BIGINT (a text that is no number raises);
a row with a null id is linked with nothing either
(component null, kept); rows that share an id and a text are in one component;
extra columns pass through ``keep_one`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from shardload.llm import wordhash
from shardload.llm.common import saved, slices, small, spread_join
from shardload.llm.graph import components

SHINGLE, PERCENT = 5, 80
COORDINATES = 64
#: Rows and shingles of one part of a group whose members are compared inside a task.
UNIT_ROWS, UNIT_SHINGLES = 1024, 2_000_000
#: How often lists of many unlinked members are posted anew by rare shingles.
DEPTH = 3

_rng = np.random.default_rng(4711)
_XOR = _rng.integers(0, 2 ** 64, COORDINATES, dtype=np.uint64)
_MUL = _rng.integers(0, 2 ** 64, COORDINATES, dtype=np.uint64) | np.uint64(1)
_CLASS = _rng.integers(0, 2 ** 64, 2, dtype=np.uint64)


def needed(percent: int) -> int:
    """Agreeing coordinates asked for: 4.7 standard deviations below what is expected at the threshold."""
    j = percent / 100
    return max(1, math.floor(COORDINATES * j - 4.7 * math.sqrt(COORDINATES * j * (1 - j))))


def _sets(texts: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """``(first, sets)``: sorted distinct shingle hashes of text ``first``, ``first + 1``, ..."""
    for first, off, h in wordhash.words(texts, wordhash.SPACES):
        grams = wordhash.shingles(h, SHINGLE) if len(h) >= SHINGLE else h[:0]
        out = []
        for a, b in zip(off[:-1], off[1:]):
            out.append(np.unique(grams[a:b - SHINGLE + 1] if b - a >= SHINGLE else wordhash.shingles(h[a:b], SHINGLE)))
        yield first, out


def _class_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set: sums of two hashes of its members."""
    sums = [np.array([wordhash.mix(s ^ x).sum(dtype=np.uint64) for s in sets], dtype=np.uint64) for x in _CLASS]
    return wordhash.mix(sums[0]).view(np.int64), sums[1].view(np.int64)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Upper halves of the least permuted hash, per set (none empty) and coordinate."""
    joined = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDINATES), dtype=np.int32)
    for k in range(COORDINATES):
        out[:, k] = (np.minimum.reduceat((joined ^ _XOR[k]) * _MUL[k], at) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for first, sets in _sets(batch.column(2).to_pylist()):
            c, c2 = _class_ids(sets)
            full = [s for s in sets if len(s)]
            sig = _signatures(full) if full else np.zeros((0, COORDINATES), np.int32)
            edges = np.cumsum([0] + [COORDINATES * bool(len(s)) for s in sets]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, len(sets)), batch.column(1).slice(first, len(sets)),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(c), pa.array(c2),
                pa.ListArray.from_arrays(pa.array(edges), pa.array(sig.ravel()))],
                ["doc_id", "text_hash", "n_shingles", "c", "c2", "sig"])


def describe(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, c, c2, sig)``: size, class and signature of every row's set."""
    schema = StructType([StructField("doc_id", LongType()), StructField("text_hash", LongType()),
                         StructField("n_shingles", LongType()), StructField("c", LongType()),
                         StructField("c2", LongType()), StructField("sig", ArrayType(IntegerType()))])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text")).mapInArrow(_describe, schema)


def _posted(classes: DataFrame, percent: int) -> DataFrame:
    """``(key, c, shared)``: the prefix of every class, in lists of at least two;
    ``shared`` is the number of the class's values that other classes have."""
    key = F.shiftleft(F.col("at.pos").cast("long"), 32).bitwiseOR(F.col("at.col").cast("long").bitwiseAND((1 << 32) - 1))
    posts = saved(classes.select("c", F.posexplode("sig")).select("c", F.struct("pos", "col").alias("at"))
                  .select("c", key.alias("key")), "postings")
    often = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    nth = F.row_number().over(Window.partitionBy("c").orderBy("n", "key"))
    size = F.count(F.lit(1)).over(Window.partitionBy("c"))
    return (posts.join(often, "key").withColumn("nth", nth).withColumn("shared", size)
            .where(F.col("nth") <= F.col("shared") - (needed(percent) - 1)).select("key", "c", "shared"))


def _full_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(c, shingles)`` of the ``wanted(id, c)`` classes, read from the texts of these rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for first, sets in _sets(batch.column(1).to_pylist()):
                edges = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                c = batch.column(0).slice(first, len(sets))
                own = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                same = pa.array(_class_ids(sets)[0] == c.to_numpy())  # another text of the id is another class
                yield pa.RecordBatch.from_arrays(
                    [c, pa.ListArray.from_arrays(pa.array(edges), pa.array(own))], ["c", "shingles"]).filter(same)

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(wanted, "id")
    return rows.select("c", "text").mapInArrow(run, "c long, shingles array<long>").dropDuplicates(["c"])


def _agree(a: str, b: str) -> Column:
    """Collisions of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)


def _compare(percent: int):
    """In a task: the rows of a unit ``(p, kind, i, j)`` follow one another.  Members of
    part ``i`` are compared with those of part ``j`` (``kind`` 0; all of them if i = j) or with
    linked ones (``kind`` 1), unless they are connected; a link is handed on where it connects."""
    enough = needed(percent)

    def links(side, c, sig, sizes, flat, same: bool) -> list[tuple[int, int]]:
        _, ids = np.unique(flat, return_inverse=True)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        mine, label, out = np.zeros(len(ids) and ids.max() + 1, dtype=bool), np.arange(len(c)), []
        if not same:  # linked members are connected through the pivot
            label[side == 2] = np.flatnonzero(side == 2)[0] if (side == 2).any() else 0
        for x in np.flatnonzero(side == 0):
            near = (sig == sig[x]).sum(axis=1) >= enough
            near &= (np.arange(len(c)) > x) if same else (side != 0)
            others = np.flatnonzero(near)
            if not len(others):
                continue
            others = others[label[others] != label[x]]
            if not len(others):
                continue
            mine[ids[edges[x]:edges[x + 1]]] = True
            if len(others) > 32:
                both = np.add.reduceat(mine[ids].astype(np.int32), edges[:-1])[others]
            else:
                both = np.array([mine[ids[edges[y]:edges[y + 1]]].sum() for y in others])
            mine[ids[edges[x]:edges[x + 1]]] = False
            for y in others[100 * both >= percent * (sizes[x] + sizes[others] - both)]:
                if label[x] != label[y]:
                    out.append((int(c[x]), int(c[y])))
                    label[label == label[y]] = label[x]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        unit = None

        def done():
            found = []
            if unit is not None and len(held) > 1:
                side = np.array([h[0] for h in held])
                found = links(side, np.array([h[1] for h in held]), np.stack([h[2] for h in held]),
                              np.array([len(h[3]) for h in held]), np.concatenate([h[3] for h in held]),
                              unit[1] == 0 and unit[2] == unit[3])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([b for _, b in found], pa.int64())], ["a", "b"])

        for batch in batches:
            p, kind, i, j, side, c = (batch.column(k).to_numpy() for k in range(6))
            sigs, sets = batch.column(6), batch.column(7)
            for r in range(batch.num_rows):
                if (p[r], kind[r], i[r], j[r]) != unit:
                    yield done()
                    unit = (p[r], kind[r], i[r], j[r])
                held.append((side[r], c[r], sigs[r].values.to_numpy(), sets[r].values.to_numpy()))
        yield done()

    return run


def _rarest(star: DataFrame, wide: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(key, c, shared)``: the members of the ``wide`` stars under their rarest shingles, in lists that have an
    unlinked member.  Of two sets of at least the similarity one shares all but so many of its shingles with the other:
    with all shingles in one order, that of their frequency in the star, the first ones must meet."""
    rows = (star.join(wide.select("p"), "p").select("p", "c", "n", "linked").join(sets, "c")
            .select("p", "c", "n", "linked", F.explode("shingles").alias("s"))
            .select("p", "c", "n", "linked", F.xxhash64("p", "s").alias("key")))
    rows = saved(rows, "rare-shingles")
    often = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "rare-counts")
    nth = F.row_number().over(Window.partitionBy("p", "c").orderBy("df", "key"))
    first = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / 100) + 1
    unshared = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("p", "c"))  # these come before all others
    rows = (spread_join(rows, often, "key", "c", thin=True).withColumn("nth", nth + unshared)
            .where(F.col("nth") <= first).select("key", "c", "linked"))
    rows = saved(rows, "rare-prefixes")
    able = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.count(F.when(~F.col("linked"), 1)).alias("free"))
            .where("k > 1 AND free > 0").select("key"))
    rows = saved(spread_join(rows, saved(able, "rare-keys"), "key", "c", thin=True).select("key", "c").distinct(), "rare-lists")
    return rows.select("key", "c", F.count(F.lit(1)).over(Window.partitionBy("c")).alias("shared"))


def _links(lists: DataFrame, full: DataFrame, percent: int, depth: int = 0) -> DataFrame:
    """Links ``(a, b)`` between classes that connect all that is connected; ``full(c, sig, shingles)`` is saved."""
    pivots = saved(lists.groupBy("key").agg(F.max(F.struct("shared", "c"))["c"].alias("p")), "pivots")
    members = saved(spread_join(lists, pivots, "key", "c", thin=True).where("c <> p").select("p", "c").distinct(), "members")
    both = F.size(F.array_intersect("x", "y"))
    star = (spread_join(members, full.select(F.col("c").alias("p"), F.col("sig").alias("sp"), F.col("shingles").alias("x")), "p", "c")
            .join(full.select("c", "sig", F.col("shingles").alias("y")), "c")
            .withColumn("near", _agree("sp", "sig") >= needed(percent))
            .select("p", "c", F.size("y").alias("n"), F.when(F.col("near"), F.struct(both.alias("i"), (
                F.size("x") + F.size("y") - both).alias("u"))).alias("o"))
            .select("p", "c", "n", F.coalesce(100 * F.col("o.i") >= percent * F.col("o.u"), F.lit(False)).alias("linked")))
    star = saved(star, "stars")
    linked = star.where("linked").select(F.col("p").alias("a"), F.col("c").alias("b"))

    # What is not linked with its pivot is dealt to parts of bounded size, and so is what it is compared with.
    def parts(on: Column) -> Column:
        n, weight = F.sum(on.cast("int")), F.sum(F.when(on, F.col("n")).otherwise(0))
        return F.greatest(F.ceil(n / UNIT_ROWS), F.ceil(weight / UNIT_SHINGLES)).cast("int")

    is_linked = F.col("linked")
    stars = saved(star.groupBy("p").agg(parts(~is_linked).alias("free_parts"), parts(is_linked).alias("linked_parts"),
                                        F.count(F.lit(1)).alias("size")).where("free_parts > 0 AND size > 1"), "open-stars")
    wide = stars.where("free_parts > 1")
    if depth < DEPTH and not wide.isEmpty():
        more = saved(_rarest(star, wide, full.select("c", "shingles"), percent), "rare-postings")
        linked = linked.unionByName(_links(more, full, percent, depth + 1))
        stars = stars.where("free_parts = 1")
    part = lambda n: F.pmod(F.xxhash64("c"), F.greatest(F.col(n), F.lit(1))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    unit = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"),
                                             j.cast("int").alias("j"), side.cast("int").alias("side"))
    own = F.col("part")
    free = F.transform(upto("free_parts"), lambda k: unit(0, F.least(own, k), F.greatest(own, k), F.when(own <= k, 0).otherwise(1)))
    met = F.when(F.col("linked_parts") > 0, F.transform(upto("linked_parts"), lambda k: unit(1, own, k, F.lit(0)))).otherwise(
        F.array().cast("array<struct<kind:int,i:int,j:int,side:int>>"))
    rest = F.transform(upto("free_parts"), lambda k: unit(1, k, own, F.lit(2)))
    dealt = (star.drop("n").join(small(stars), "p")
             .withColumn("part", F.when(is_linked, part("linked_parts")).otherwise(part("free_parts")))
             .select("p", "c", F.explode(F.when(is_linked, rest).otherwise(F.concat(free, met))).alias("u"))
             .select("p", "u.kind", "u.i", "u.j", "u.side", "c"))
    key = ["p", "kind", "i", "j"]
    met = (dealt.join(full, "c").select(*key, "side", "c", "sig", "shingles")
           .repartition(*key).sortWithinPartitions(*key, "side", "c").mapInArrow(_compare(percent), "a long, b long"))
    return linked.unionByName(saved(met, "links"))


def _grouped(docs: DataFrame, percent: int, doc_id: str, text: str) -> DataFrame:
    """``groups`` and ``root``, the class that names a row's group (null: the row is its own)."""
    rows = saved(describe(docs, doc_id, text), "sets")
    able = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = able.groupBy("c", "c2").agg(F.min("doc_id").alias("id"))
    classes = saved(able.join(firsts.withColumnRenamed("id", "doc_id"), ["c", "c2", "doc_id"])
                    .select("c", "doc_id", "sig").dropDuplicates(["c"]), "classes")
    lists = saved(_posted(classes, percent), "lists")
    wanted = saved(classes.join(lists.select("c").distinct(), "c", "left_semi").select(F.col("doc_id").alias("id"), "c"),
                   "wanted")
    full = saved(_full_sets(docs, small(wanted), doc_id, text).join(classes.select("c", "sig"), "c"), "full-sets")
    links = _links(lists, full, percent)
    root = saved(components(links).withColumnRenamed("node", "c"), "components")
    least = saved(root.join(classes, "c").groupBy("root").agg(F.min("doc_id").alias("least")), "least-ids")
    moved = spread_join(root, least, "root", "c", thin=True)
    ids = classes.join(moved, "c", "left").select("c", F.coalesce("root", "c").alias("root"),
                                                  F.coalesce("least", "doc_id").alias("component"))
    ids = small(saved(ids, "class-components"))
    able = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    own = F.when(able, F.col("component")).otherwise(F.col("doc_id"))
    return (rows.drop("sig").join(ids, "c", "left")
            .select("doc_id", "text_hash", "n_shingles", own.alias("component_id"),
                    F.col("doc_id").eqNullSafe(own).alias("kept"), F.when(able, F.col("root")).alias("root")))


def groups(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, component_id, kept)`` for every row of
    ``docs``; ``component_id`` is the smallest id that links of at least
    ``percent`` similarity reach."""
    return _grouped(docs, percent, doc_id, text).drop("root")


def keep_one(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every group: the smallest id, of equal ids the
    smallest text hash, of equal rows any.  Rows without a set all stay."""
    rows = saved(_grouped(docs, percent, doc_id, text).where("root IS NOT NULL"), "groups")
    same = rows.groupBy("doc_id", "text_hash", "root", "kept").agg(F.count(F.lit(1)).alias("n"))
    first = same.where("kept")  # the smallest id of a group, once for each of its texts
    least = first.groupBy("root").agg(F.min("text_hash").alias("least"))
    first = first.join(least, "root").withColumn("best", F.col("text_hash") == F.col("least")).where("n > 1 OR NOT best")
    columns = ["doc_id", "text_hash", "best"]
    marks = saved(first.select(columns).unionByName(
        same.where("NOT kept").withColumn("best", F.lit(False)).select(columns)), "marks")
    mark = small(marks).select(F.struct("doc_id", "text_hash", "best").alias("__mark"))
    joined = docs.join(mark, (F.col(f"`{doc_id}`").cast("long") == F.col("__mark.doc_id"))
                       & (F.xxhash64(F.col(f"`{text}`")) == F.col("__mark.text_hash")), "left")
    out = joined.where("__mark IS NULL").drop("__mark")
    if not marks.where("best").isEmpty():  # equal rows of a kept id: one of them
        out = out.unionByName(joined.where("__mark.best").dropDuplicates(["__mark"]).drop("__mark"))
    return out
