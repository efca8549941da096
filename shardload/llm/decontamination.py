"""Benchmark decontamination with SimHash windows.

Words are runs of letters and digits (A-Z lower-cased).  Windows of a
document as long as a benchmark item get a 64-bit SimHash of their five-word
shingles.  A multi-index over eight blocks of a byte finds every item
fingerprint within ``RADIUS`` bits: of ``8 * 3 - 1`` differing bits at most, some
block has at most two.  What it finds is verified by the exact similarity of
the shingles weighted by their counts.  Only windows that hold a shingle of an
item get a fingerprint, as any other has similarity 0.

The documents are read once, whatever the number of items: a bit filter of the items'
shingles (``FILTER_BITS`` at most) says which texts may hold one; their shingles are
joined with those of the items, and each text is compared with the items that it shares
one with, inside tasks.  Equal texts are compared once.  The items stay in a table.

Defined results: items and documents with fewer than ``SHINGLE`` words (null and
empty ones too) match nothing; a document shorter than an item is one window;
per document and item the best window is returned, the first of equals;
repeated rows, of either side, match each for itself; extra columns are ignored
(or pass unchanged through ``drop_contaminated``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardload.llm import wordhash
from shardload.llm.common import saved, slices, small

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, PER_BLOCK = 8, 2
RADIUS = BLOCKS * (PER_BLOCK + 1) - 1
#: Items that a text is compared with at once, expected.
ITEMS = 2000
#: Width of the places in the bit filter: two for each shingle, 64 bits a shingle up to the larger bound.
FILTER_BITS = (16, 24)

_BITS = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


@dataclass
class Items:
    """Benchmark items that a text is compared with, ready for lookups."""
    ids: list = field(default_factory=list)
    grams: list = field(default_factory=list)     # sorted shingle hashes of an item, with repeats
    known: np.ndarray = None                      # all distinct shingle hashes, sorted
    filter: np.ndarray = None                     # which upper 20 bits occur
    by_gram: list = field(default_factory=list)   # item numbers of each of ``known``
    by_size: dict = field(default_factory=dict)   # shingles -> (item numbers, fingerprints, block table)


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sums per bit -> bytes of the fingerprints, one row each."""
    return np.packbits(sums >= 0, axis=-1)


def _signs(grams: np.ndarray) -> np.ndarray:
    """+1 or -1 for every bit of every hash."""
    return np.unpackbits(grams.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1


def index(rows: list[tuple[object, str]]) -> Items:
    items = Items()
    first: dict[int, list[int]] = {}
    for item_id, text in rows:
        for _, off, h in wordhash.words([text], wordhash.NOT_ALNUM):
            if len(h) < SHINGLE:
                continue
            g = wordhash.shingles(h, SHINGLE)
            for x in np.unique(g).tolist():
                first.setdefault(x, []).append(len(items.ids))
            items.ids.append(item_id)
            items.grams.append(np.sort(g))
    items.known = np.array(sorted(first), dtype=np.uint64)
    items.by_gram = [first[int(x)] for x in items.known]
    items.filter = np.zeros(1 << 20, dtype=bool)
    items.filter[(items.known >> np.uint64(44)).astype(np.int64)] = True
    near = _BITS[np.bitwise_xor.outer(np.arange(256), np.arange(256))] <= PER_BLOCK
    for size in {len(g) for g in items.grams}:
        who = np.array([k for k, g in enumerate(items.grams) if len(g) == size])
        prints = np.stack([_fingerprints(_signs(items.grams[k]).sum(axis=0)) for k in who])
        items.by_size[size] = who, prints, [near[:, prints[:, j]] for j in range(BLOCKS)]
    return items


def _similarity(window: np.ndarray, item: np.ndarray) -> float:
    """Sum of the smaller over sum of the larger counts of each shingle."""
    a, na = np.unique(window, return_counts=True)
    b, nb = np.unique(item, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = int(np.minimum(na[i], nb[j]).sum())
    return both / (len(window) + len(item) - both)


def find(grams: np.ndarray, items: Items) -> dict[int, tuple[float, int]]:
    """item number -> (similarity, first word) of its best window among a document's shingles."""
    maybe = np.flatnonzero(items.filter[(grams >> np.uint64(44)).astype(np.int64)])
    if not len(maybe) or not len(items.known):
        return {}
    at = np.minimum(np.searchsorted(items.known, grams[maybe]), len(items.known) - 1)
    sure = items.known[at] == grams[maybe]
    places, at = maybe[sure], at[sure]
    if not len(places):
        return {}
    hit: dict[int, set] = {}  # shingles of an item -> places of theirs in the document
    for p, g in zip(places.tolist(), at.tolist()):
        for size in {len(items.grams[k]) for k in items.by_gram[g]}:
            hit.setdefault(size, set()).add(p)
    best: dict[int, tuple[float, int]] = {}
    for size, where in sorted(hit.items()):
        who, prints, tables = items.by_size[size]
        n = min(size, len(grams))
        p = np.array(sorted(where))
        starts = np.unique(np.clip(p[:, None] - np.arange(n)[None, :], 0, len(grams) - n))
        # sums per bit of all windows, run of neighbouring starts by run
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
            for part in np.array_split(run, -(-len(run) // 4096)):
                sums = np.zeros((part[-1] + n - part[0] + 1, 64), dtype=np.int32)
                np.cumsum(_signs(grams[part[0]:part[-1] + n]), axis=0, out=sums[1:])
                own = _fingerprints(sums[part - part[0] + n] - sums[part - part[0]])
                found = np.zeros((len(part), len(who)), dtype=bool)
                for j, table in enumerate(tables):
                    found |= table[own[:, j]]
                for w, k in zip(*np.nonzero(found)):
                    if _BITS[own[w] ^ prints[k]].sum() > RADIUS:
                        continue
                    s = _similarity(grams[part[w]:part[w] + n], items.grams[who[k]])
                    if s >= SIMILARITY and s > best.get(who[k], (0.0,))[0]:
                        best[who[k]] = (s, int(part[w]))
    return best


def _each(texts: list, items: Items) -> Iterator[tuple[int, dict]]:
    """The matches of every text that has some."""
    for first, off, h in wordhash.words(texts, wordhash.NOT_ALNUM):
        if not len(h):
            continue
        long = np.flatnonzero(np.diff(off) >= SHINGLE)
        grams = wordhash.shingles(h, SHINGLE)
        flagged = np.concatenate([[0], np.cumsum(items.filter[(grams >> np.uint64(44)).astype(np.int64)])])
        for k in long:
            a, b = off[k], off[k + 1] - SHINGLE + 1
            if flagged[b] > flagged[a]:
                if found := find(grams[a:b], items):
                    yield first + k, found


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(item, gram)``: the distinct shingles of every item."""
    for batch in batches:
        numbers, found = batch.column(0).to_numpy(), []
        for first, off, h in wordhash.words(batch.column(1).to_pylist(), wordhash.NOT_ALNUM):
            grams = wordhash.shingles(h, SHINGLE) if len(h) >= SHINGLE else h[:0]
            found += [(numbers[first + k], np.unique(grams[off[k]:off[k + 1] - SHINGLE + 1]))
                      for k in np.flatnonzero(np.diff(off) >= SHINGLE)]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([i for i, _ in found], [len(g) for _, g in found]).astype(np.int64)),
            pa.array(np.concatenate([g for _, g in found]).view(np.int64) if found else np.zeros(0, np.int64))], ["item", "gram"])


class _Filter:
    """Two bit tables of the shingles' upper bits and of the bits below these."""

    def __init__(self, grams: DataFrame):
        low, high = FILTER_BITS
        self.bits = min(high, max(low, (64 * grams.count()).bit_length()))
        places = [F.shiftrightunsigned(F.shiftleft("gram", self.bits * k), 64 - self.bits) for k in range(2)]
        self.tables = [self._table(grams.select(p.alias("p")).distinct().toArrow()["p"].to_numpy()) for p in places]

    def _table(self, places: np.ndarray) -> np.ndarray:
        held = np.zeros(1 << self.bits, dtype=bool)  # at most 2^FILTER_BITS places, whatever the items
        held[places] = True
        return np.packbits(held)

    def open(self):
        tables, down, bits = [np.unpackbits(t).view(bool) for t in self.tables], np.uint64(64 - self.bits), np.uint64(self.bits)

        def places(grams: np.ndarray) -> np.ndarray:
            at = np.flatnonzero(tables[0][(grams >> down).astype(np.int64)])
            return at[tables[1][((grams[at] << bits) >> down).astype(np.int64)]]
        return places


def _candidates(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``(doc_id, digest, text, grams)`` of the rows of ``docs(doc_id, text)`` that may hold an item's shingle."""
    held = _Filter(grams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = held.open()
        for batch in slices(batches):
            texts, rows, own = batch.column(1).to_pylist(), [], []
            for first, off, h in wordhash.words(texts, wordhash.NOT_ALNUM):
                if len(h) < SHINGLE:
                    continue
                g = wordhash.shingles(h, SHINGLE)
                at = places(g)
                begin, end = np.searchsorted(at, off[:-1]), np.searchsorted(at, off[1:] - SHINGLE + 1)
                for k in np.flatnonzero(end > begin):  # shingles over the end of a text are none
                    rows.append(first + k)
                    own.append(np.unique(g[at[begin[k]:end[k]]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array([hashlib.md5(texts[r].encode("utf-8", "surrogatepass")).hexdigest() for r in rows], pa.string()),
                batch.column(1).take(pa.array(rows, pa.int64())), pa.array(own, pa.list_(pa.int64()))],
                ["doc_id", "digest", "text", "grams"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return saved(docs.mapInArrow(run, f"doc_id {kind}, digest string, text string, grams array<long>"), "contaminated-texts")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best window of every text for each item that is similar to it."""
    for batch in batches:
        out = []
        for digest, text, items in zip(*(c.to_pylist() for c in batch.columns)):
            block = index(sorted((x["item"], x["words"]) for x in items))
            for _, found in _each([text], block):
                out += [(digest, block.ids[k], first, len(block.grams[k]) + SHINGLE - 1, s) for k, (s, first) in found.items()]
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["digest", "item", "first_word", "n_words", "similarity"])


def _found(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, ``(digest, item, first_word, n_words, similarity)``, and the numbered items."""
    items = saved(benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_id).alias("item_id"), F.col(item_text).alias("words"), F.monotonically_increasing_id().alias("item")), "benchmark")
    grams = saved(items.select("item", "words").mapInArrow(_grams, "item long, gram long"), "benchmark-shingles")
    texts = _candidates(docs, grams)
    one = saved(texts.select("digest", "text", "grams").dropDuplicates(["digest"]), "contaminated-distinct")
    parts = max(1, -(-items.count() // ITEMS))
    pairs = one.select("digest", F.explode("grams").alias("gram")).join(grams, "gram").select("digest", "item").distinct()
    own = (pairs.join(items.select("item", "words"), "item").withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
           .groupBy("digest", "part").agg(F.collect_list(F.struct("item", "words")).alias("items")))
    rows = one.select("digest", "text").join(own, "digest").select("digest", "text", "items")
    found = rows.mapInArrow(_compared, "digest string, item long, first_word long, n_words long, similarity double")
    return texts, saved(found, "contaminated"), items


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, similarity)``: every document and item with a similar window."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts, found, items = _found(source, benchmark, item_id, item_text)
    return (texts.select("doc_id", "digest").join(small(found), "digest").join(items.select("item", "item_id"), "item")
            .select("doc_id", "item_id", "first_word", "n_words", "similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` without a window similar to a benchmark item, all columns unchanged."""
    source = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    _, found, _ = _found(source, benchmark, item_id, item_text)
    bad = small(saved(found.select(F.struct("digest").alias("__bad")).distinct(), "contaminated-digests"))
    return docs.join(bad, F.md5(F.col(f"`{text}`").cast("binary")) == F.col("__bad.digest"), "left_anti")
