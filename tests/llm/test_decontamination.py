import random
import re
from collections import Counter

import numpy as np

from shardload.llm import decontamination as D
from shardload.llm import wordhash

from llm_helpers import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return [tuple(w[k:k + 5]) for k in range(len(w) - 4)]


def brute(docs, bench):
    out = {}
    for i, t in docs:
        g = grams(t)
        for j, b in bench:
            h = grams(b)
            if not g or not h:
                continue
            n, want, best = min(len(g), len(h)), Counter(h), (0.0, 0)
            for s in range(len(g) - n + 1):
                both = sum((Counter(g[s:s + n]) & want).values())
                sim = both / (n + len(h) - both)
                if sim >= D.SIMILARITY and sim > best[0]:
                    best = (sim, s)
            if best[0]:
                out[i, j] = best
    return out


def fixture():
    rnd = random.Random(4)
    bench = [(k, prose(100 + k, rnd.choice([5, 12, 30, 60]))) for k in range(25)] + [(25, "too short"), (26, None), (27, "")]
    docs = []
    for d in range(60):
        words = prose(500 + d, rnd.choice([0, 3, 40, 200])).split()
        if d % 2:
            item = bench[d % 25][1].split()
            if d % 4 == 1 and len(item) > 20:
                item[-1 - d % 3] = "changed"
            if d % 8 == 7:
                item = item * 2
            at = rnd.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((d, (" \n" if d % 3 else ", ").join(w.upper() if d % 5 == 0 else w for w in words)))
    return docs + [(60, None), (61, bench[3][1])], bench


def test_against_brute_force(spark):
    docs, bench = fixture()
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string").repartition(3)
    bm = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in D.matches(df, bm).collect()}
    assert got == brute(docs, bench) and len(got) > 25
    clean = D.drop_contaminated(df, bm)
    assert clean.columns == df.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted({i for i, _ in docs} - {i for i, _ in got})


def test_blocks_of_items(spark, monkeypatch):
    docs, bench = fixture()
    monkeypatch.setattr(D, "ITEMS", 4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.matches(df, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert got == set(brute(docs, bench))


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    near = D._BITS[np.bitwise_xor.outer(np.arange(256), np.arange(256))] <= D.PER_BLOCK
    for flips in (0, 7, D.RADIUS):
        for _ in range(200):
            a = rng.integers(0, 256, 8, dtype=np.uint8)
            bits = np.unpackbits(a)
            bits[rng.choice(64, flips, replace=False)] ^= 1
            b = np.packbits(bits)
            assert any(near[x, y] for x, y in zip(a, b))


def test_word_hashes_of_parts(monkeypatch):
    text = prose(9, 3000) + " É—x\t\n end"
    (_, _, whole), = wordhash.words([text], wordhash.SPACES)
    monkeypatch.setattr(wordhash, "BLOCK", 100)
    (_, off, cut), = wordhash.words([text], wordhash.SPACES)
    assert np.array_equal(whole, cut) and off.tolist() == [0, len(cut)] and len(cut) == len(text.split())
    assert len(np.unique(whole)) == len(set(text.split()))


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, prose(3, 50)), (3, prose(3, 50))], "item_id long, text string")
    got = D.matches(edge_docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.similarity) for r in got] == [(4, 3, 1.0)] * 2
    assert D.matches(no_docs, bench).count() == 0 and D.matches(edge_docs, bench.where("item_id = 9")).count() == 0
    assert D.drop_contaminated(edge_docs, bench).count() == edge_docs.count() - 1


def test_many_items_one_scan(spark, scratch):
    """20,000 items: the documents are read once for all of them, and the result is that of a plain search."""
    rnd = random.Random(8)
    bench = [(k, prose(10_000 + k, rnd.choice([6, 15]))) for k in range(20_000)]
    docs = [(d, prose(90_000 + d, 30) + " " + bench[d * 37][1] * (d % 2) + " tail of it") for d in range(120)]
    path = f"{scratch}/docs"
    spark.createDataFrame(docs, "doc_id long, text string").repartition(4).write.parquet(path)
    source = spark.read.parquet(path)
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b
    out = D.matches(source.mapInArrow(count, source.schema), spark.createDataFrame(bench, "item_id long, text string").repartition(5))
    got = {(r.doc_id, r.item_id) for r in out.collect()}
    assert counted.value == len(docs)
    near = {i: set(grams(t)) for i, t in docs}
    by_gram = {}
    for j, t in bench:
        for g in grams(t):
            by_gram.setdefault(g, set()).add(j)
    some = {(i, j) for i, g in near.items() for x in g for j in by_gram.get(x, ())}
    want = set()
    text, items = dict(docs), dict(bench)
    for i, j in some:
        want |= set(brute([(i, text[i])], [(j, items[j])]))
    assert got == want and len(got) >= 60


def test_copies_of_a_text_match_each_for_itself(spark):
    item = prose(3, 40)
    rows = [(k, f"start {item} end") for k in range(300)] + [(None, f"start {item} end"), (900, "clean text of some words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([("a", item), ("a", item), ("b", prose(4, 40))], "item_id string, text string")
    got = D.matches(docs, bench).collect()
    assert Counter(r.item_id for r in got) == {"a": 602}
    assert [r.doc_id for r in D.drop_contaminated(docs, bench).collect()] == [900]
