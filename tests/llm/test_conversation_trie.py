import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardload.llm import conversation_trie as T


def rebuild(rows):
    """conv_id -> its rebuilt turns, from (conv_id, turn, role, text) rows."""
    def key(r):
        _, turn, role, text = r
        role, text = role or "", text or ""
        return (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest())

    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = {c: tuple(t) for c, t in rebuild(rows).items()}
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for prefix in members:
        if prefix:
            kids[prefix[:-1]] = kids.get(prefix[:-1], 0) + 1
    leaves, saved = {}, {}
    for prefix, own in members.items():
        for d in range(len(prefix) + 1):
            up = prefix[:d]
            leaves[up] = leaves.get(up, 0) + (prefix not in kids)
            saved[up] = saved.get(up, 0) + ((len(own) - 1) * len(prefix[-1][1]) if prefix else 0)
    out = []
    for prefix, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(prefix))
        out.append((min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own), kids.get(prefix, 0),
                    leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def same(got, rows):
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def corpus(seed, n=220, alphabet=3, longest=7):
    """Conversations of few different turns, so that prefixes, copies and extensions abound."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-40, 3000), n):
        length = rnd.choice([1, 2, longest, rnd.randrange(1, longest + 1)])
        rows += [(c, t, rnd.choice(["user", None]), rnd.choice(["", "añ", "hello", None][:alphabet])) for t in range(length)]
    twin = [r for r in rows if r[0] == rows[0][0]]
    rows += [(5000 + 100 * k, t, role, text) for k in range(80) for _, t, role, text in twin]  # many copies of one
    rows += [(20_000 + k, t, "user", f"only {k} {t}" * (t > 2)) for k in range(30) for t in range(9)]
    return rows


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 4), (3, 23)])
def test_against_brute_force(spark, seed, partitions):
    rows = corpus(seed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:  # many small partitions: most nodes are open and merged across boundaries
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = T.nodes(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert got.columns == T.NODE
        same(got, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_edges(spark):
    rows = [(None, 0, "user", "x"), (100, None, "user", "b"), (100, None, None, None), (100, 0, "a", "b"), (100, 0, "a", "b"),
            (101, 5, "user", None), (102, 1, None, ""), (3, 0, "user", "long " * 200_000), (4, 1, "user", "long " * 200_000),
            (-7, 0, "user", "neg"), (200, 0, "user", "z")]
    rows += [(250 + k, 0, "user", "one turn") for k in range(40)]  # those whose base gives fewer turns than they drop stay short
    rows += [(7000 + 100 * k, 0, "user", "of 7000") for k in range(6)] + [(7777, t, "user", "cut") for t in range(2)]
    df = spark.createDataFrame([r + (1, "x", 2.0) for r in rows], SCHEMA + ", c long, depth string, n double")
    same(T.nodes(df), rows)
    none = T.nodes(df.where("conv_id = -1"))
    assert none.columns == T.NODE and none.count() == 0
    for few in ([(100, 0, "user", "alone")], [(c, 0, "user", "x") for c in (101, 102, 103)]):
        same(T.nodes(spark.createDataFrame(few, SCHEMA)), few)


def test_one_conversation_over_many_partitions(spark):
    """Positions, prefixes and characters of a key that range partitioning cuts."""
    rows = [(1, t, t * 7 % 13, t % 5) for t in range(5000)] + [(0, 0, 3, 4), (2, 1, 5, 6)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, "k long, o long, x long, s long").orderBy(F.rand(1))
        got = sorted(map(tuple, T.running(df, "k", "o", ("x",), ("s",)).collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = [(0, 0, 3, 4, 1)]
    x = s = 0
    for n, (_, t, a, b) in enumerate(rows[:5000], 1):
        x, s = x ^ a, s + b
        want.append((1, t, x, s, n))
    assert got == want + [(2, 1, 5, 6, 1)]


def test_closed_nodes_leave_the_partition_whole():
    """One partition alone: every inner branching is closed, only prefixes of the outermost paths are open."""
    paths = [[1, 2], [1, 3, 4], [1, 3, 5], [6, 7], [6, 8], [9]]
    shared = [[1], [1, 3], [1, 3], [6], [6], []]
    ids = {}
    flat = [(ids.setdefault(tuple(p[:d + 1]), len(ids) + 1), d + 1) for p, s in zip(paths, shared) for d in range(len(s))]
    edge = np.r_[0, np.cumsum([len(s) for s in shared])]
    one = np.ones(len(paths), np.int64)
    f = T.Forest(np.arange(10, 16), one, np.array([len(p) for p in paths]), one * 0, one, edge,
                 np.array([a for a, _ in flat]), np.zeros(len(flat), np.int64), np.array([d for _, d in flat]))
    f.run()
    rows = [dict(zip(T._FIELDS, r)) for r in f.rows]
    closed = {(r["conv"], r["depth"], r["n"], r["children"], r["parent"]) for r in rows if r["kind"] == T.CLOSED}
    assert closed == {(11, 2, 2, 2, None), (13, 1, 2, 2, None)}
    opened = {(r["conv"], r["depth"], r["n"], r["children"]) for r in rows if r["kind"] == T.OPEN}
    assert opened == {(10, 0, 6, 2), (10, 1, 3, 2)}
    assert sum(r["kind"] == T.TAIL for r in rows) == 6


def test_digests_of_large_classes(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 7)
    members = [(5, 5 + 3 * k) for k in range(500)] + [(1, 1), (1, 2), (9, 9)]
    got = {r.rep: r.sha for r in T._digests(spark.createDataFrame(members, "rep long, c long").repartition(5)).collect()}
    for rep in (1, 5, 9):
        ids = ",".join(str(c) for r, c in sorted(members) if r == rep)
        assert got[rep] == hashlib.sha256(ids.encode()).hexdigest()
