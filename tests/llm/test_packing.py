import bisect
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shardload.llm import packing
from shardload.llm.subwords import RunIds

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_best_fit(lengths, size):
    """Piece by piece, with a sorted list of open windows; returns how many windows have each filling."""
    room = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(room, n)
        left = (room.pop(i) if i < len(room) else size) - n
        bisect.insort(room, left)
    return Counter(size - r for r in room)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120), st.sampled_from([30, 31, 64]))
def test_best_fit_counts(lengths, size):
    counts = Counter(lengths)
    runs, windows = packing.best_fit(counts, size)
    used, places = {}, {}
    for length, lo, hi, first, per, at in runs:
        for r in range(lo, hi + 1):
            assert (length, r) not in places
            places[length, r] = first + (r - lo) // per, at + (r - lo) % per * length
    assert set(places) == {(n, r) for n, k in counts.items() for r in range(k)}
    for (n, _), (w, at) in places.items():
        used.setdefault(w, []).append((at, n))
    assert set(used) == set(range(windows))
    for pieces in used.values():
        end = 0
        for at, n in sorted(pieces):
            assert at == end
            end += n
        assert end <= size
    assert Counter(sum(n for _, n in p) for p in used.values()) == plain_best_fit(lengths, size)


def check(spark, df, size):
    rows = packing.pack(df, PATH, size=size).collect()
    tok = Tokenizer.from_file(PATH)
    want = Counter()
    for r in df.collect():
        want[tuple(tok.encode(r.text or "", add_special_tokens=False).ids + [1])] += 1
    docs, sequences = {}, {}
    for p in rows:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, tuple(ids)))
    for pieces in sequences.values():
        assert sum(n for _, n in pieces) <= size
        end = 0
        for at, n in sorted(pieces):
            assert at == end
            end += n
    assert sum(p.length for p in rows) == sum(len(k) * n for k, n in want.items())
    return rows, want, docs


def test_round_trip(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["alpha", "Béta,", "g9", "x"]) for _ in range(rnd.randrange(90))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows, want, docs = check(spark, df, 32)
    for (_, n), pieces in docs.items():
        whole = tuple(x for _, ids in sorted(pieces) for x in ids)
        assert len(whole) == n and want[whole]


def test_edges(spark, edge_docs, no_docs):
    rows, *_ = check(spark, edge_docs, 2048)
    assert packing.pack(no_docs, PATH).count() == 0
    assert sorted(r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)) == [1, 1, 1]


@pytest.mark.parametrize("text", ["a\x1cb", "x\xa0y z　w", "<|endoftext|> a<|endoftext|>b", "é É", "it's we'll'd",
                                  "ΣΑΣ İx ǅ", "日本 語", "a" * 300, "́x", "1234 5", "%%%!!", "​q"])
def test_ids_equal_the_whole_text(text):
    words, tok = RunIds(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
