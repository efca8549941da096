"""What a Python worker holds of a batch of texts does not grow with the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from shardload.llm import common, ngrams, quality, wordhash
from shardload.llm import near_dedup as N

rnd = random.Random(5)
WORDS = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(2, 9))) for _ in range(3000)]


def batch(rows):
    texts = [" ".join(rnd.choices(WORDS, k=400)) for _ in range(rows)]
    return pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array([0] * rows, pa.int64()), pa.array(texts)],
                                      ["doc_id", "text_hash", "text"])


def peak(run, rows):
    b = batch(rows)
    tracemalloc.start()
    for _ in run(iter([b])):
        pass
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return top / 1e6


def test_what_a_worker_holds_is_bounded():
    model = quality.Model(np.ones(quality.FEATURES), np.ones(quality.FEATURES), 0.0, 1.0, 0.0)

    def scored(batches):
        for b in common.slices(batches):
            yield quality._scores(b.column(2).to_pylist(), model)

    for run in (N._describe, scored):
        run(iter([batch(10)]))
        few, many = peak(run, 1500), peak(run, 6000)
        assert many < 30 and many < 1.5 * few, (run, few, many)


def test_slices_lose_no_row(monkeypatch):
    monkeypatch.setattr(common, "SLICE_ROWS", 7)
    empty, b = batch(0), batch(40)
    got = list(common.slices(iter([empty, b, b])))
    assert max(x.num_rows for x in got) == 7
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([b, b]))
    whole = pa.Table.from_batches(N._describe(iter([b]))).to_pylist()
    monkeypatch.setattr(wordhash, "BLOCK", 1000)
    monkeypatch.setattr(common, "SLICE_ROWS", 512)
    assert pa.Table.from_batches(N._describe(iter([b]))).to_pylist() == whole


def test_blocks_do_not_change_ngrams(monkeypatch):
    texts = batch(30).column(2).to_pylist() + ["", None, "ab"]

    def all_of():
        out = {}
        for i, x in ngrams.blocks(texts, (1, 2, 3), 16):
            out.setdefault(i, []).extend(x.tolist())
        return {i: sorted(x) for i, x in out.items()}

    whole = all_of()
    monkeypatch.setattr(ngrams, "BLOCK", 500)
    assert all_of() == whole
