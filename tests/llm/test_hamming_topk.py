import random

import pytest

from shardload.llm import hamming_topk


def brute(rows, asked, k):
    out = set()
    for q, c in asked:
        near = sorted((bin((c ^ d) & (2 ** 64 - 1)).count("1"), i) for i, d in rows)[:k]
        out |= {(q, rank, i, dist) for rank, (dist, i) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("segments", [None, 3, 16])
def test_exact(spark, monkeypatch, segments):
    rnd = random.Random(5)
    rows = [(i, rnd.getrandbits(64) - 2 ** 63) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # many equal codes
    rows += [(2000 + i, rows[7][1] ^ (1 << rnd.randrange(60))) for i in range(40)]
    if segments:
        monkeypatch.setattr(hamming_topk, "segments_for", lambda rows, bits: segments)
    if segments == 3:  # wide segments: masks of 22 bits are many, near codes need few of them
        rows = [(i, c & 0xFFFF) for i, c in rows]
    asked = rows[:6] + rows[-2:]
    df = spark.createDataFrame(rows, "id long, code long")
    got = hamming_topk.topk(df, spark.createDataFrame(asked, "id long, code long"), k=7).collect()
    assert {tuple(r) for r in got} == brute(rows, asked, 7)


def test_edges(spark):
    rows = [(0, [1.0, -1.0]), (100, None), (200, []), (300, [1.0, None]), (None, [1.0]), (1, [0.5] * 70)]
    df = spark.createDataFrame([r + (1, 2) for r in rows], "vec_id long, embedding array<float>, code long, id long")
    got = hamming_topk.vector_topk(df, k=5).collect()
    assert {r.query_id for r in got} == {0, 300} and len(got) == 8
    assert [r.distance for r in sorted(got) if r.query_id == 0] == [0, 0, 0, 63]
    assert hamming_topk.vector_topk(df.where("vec_id = -1")).count() == 0
