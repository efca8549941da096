"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader and elastic-net
penalties, followed by temperature calibration.

Document frequencies come from every training row, and every non-null language is
learned.  The weights are fitted on a bounded sample of the rows: ``SAMPLE_ROWS``
expected, the same number per language, but ``LEAST_ROWS`` of each language (or all it
has) if that is more, and a quarter more at most; every fifth sampled row is kept for
the calibration.  Rows are drawn by a hash of id and text, and where the draw goes over
its bound those of least hash stay, so the model does not depend on the order of tasks.
Training holds state for the n-grams that the sample has; tasks get the weights that
the L1 penalty leaves.  Prediction reads whole texts: the weighted sum over all n-grams.

Defined results: a null text, or one without a letter, gets ``und`` and score
0; with no training row every text does; ties between languages go to the first
in sorted order; repeated rows are predicted each for itself; extra columns pass if kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.llm import ngrams
from shardload.llm.common import saved, small

ORDERS, BITS = (1, 2, 3), 16
SAMPLE_ROWS, LEAST_ROWS = 3000, 20
#: Languages up to which tasks lay the weights out in full.
DENSE_LANGS = 64
#: FTRL: learning rate, its offset, the L1 and L2 penalties, passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.1, 1.0, 0.05, 0.1, 4
#: Scale of the TF-IDF values, which are relative frequencies times IDF.
SCALE = 20.0

UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    edges: np.ndarray   # of every bucket, where its weights begin
    of: np.ndarray      # the language of each weight
    values: np.ndarray  # the weights that are not zero, IDF and scale multiplied in
    bias: np.ndarray
    temperature: float


class _Sums:
    """Summed weights of the buckets of a text."""

    def __init__(self, model: Model):
        self.model, self.n = model, max(1, len(model.langs))
        self.dense = None
        if len(model.langs) <= DENSE_LANGS:
            self.dense = np.zeros((1 << BITS, self.n), np.float32)
            self.dense[np.repeat(np.arange(1 << BITS), np.diff(model.edges)), model.of] = model.values

    def of(self, buckets: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[buckets].sum(axis=0)
        own, count = np.unique(buckets, return_counts=True)
        size = self.model.edges[own + 1] - self.model.edges[own]
        at = np.repeat(self.model.edges[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.model.of[at], weights=self.model.values[at] * np.repeat(count, size), minlength=self.n)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of what a task reads; features of the sampled rows."""
    df = np.zeros(1 << BITS, dtype=np.int64)
    seen = np.zeros(1 << BITS, dtype=bool)

    def rows(buckets, dfs, langs, feats, counts):
        return pa.RecordBatch.from_arrays([
            pa.array(buckets, pa.int32()), pa.array(dfs, pa.int64()), pa.array(langs, pa.string()),
            pa.array(feats, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "df", "lang", "feats", "counts"])

    for batch in batches:
        texts = [(t or "").lower() for t in batch.column(0).to_pylist()]
        langs, sampled = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        kept: dict[int, np.ndarray] = {}
        last = -1
        for i, b in ngrams.blocks(texts, ORDERS, BITS):
            if i != last:
                df += seen
                seen[:] = False
                last = i
            seen[b] = True
            if sampled[i]:
                kept[i] = kept.get(i, 0) + np.bincount(b, minlength=1 << BITS)
                if len(kept) == 64:  # rows that are done are handed on, so few dense counts are held
                    yield rows(*_sparse({k: kept.pop(k) for k in list(kept) if k != i}, langs))
        df += seen
        seen[:] = False
        if kept:
            yield rows(*_sparse(kept, langs))
    at = np.flatnonzero(df)
    none = [None] * len(at)
    yield rows(at.astype(np.int32), df[at], none, none, none)


def _sparse(kept: dict, langs: list):
    ids = list(kept)
    at = [np.flatnonzero(kept[i]).astype(np.uint32) for i in ids]
    none = [None] * len(ids)
    return (none, none, [langs[i] for i in ids], [a.tobytes() for a in at],
            [kept[i][a].astype(np.uint32).tobytes() for i, a in zip(ids, at)])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(rows: list, n_langs: int) -> np.ndarray:
    """FTRL-proximal, one example at a time; the last weight row is the bias (no L1 there).  Rows of buckets
    that no example has are zero; state is held for the others."""
    met = np.unique(np.concatenate([at for at, *_ in rows])) if rows else np.zeros(0, np.uint32)
    rows, d = [(np.searchsorted(met, at), x, y) for at, x, y in rows], len(met)
    z, n = np.zeros((d + 1, n_langs)), np.zeros((d + 1, n_langs))
    l1 = np.full((d + 1, 1), L1)
    l1[d] = 0.0

    def weights(at):
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            at, x, y = rows[k]
            at, x = np.append(at, d), np.append(x, 1.0)
            w = weights(at)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    out = np.zeros(((1 << BITS) + 1, n_langs), np.float32)
    out[np.append(met, 1 << BITS)] = weights(np.arange(d + 1))
    return out


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood (golden section over its logarithm)."""
    if not len(y):
        return 1.0
    nll = lambda t: -np.log(_softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    a, b, g = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, e = b - g * (b - a), a + g * (b - a)
        a, b = (a, e) if nll(c) < nll(e) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from ``text`` and non-null ``lang`` of the rows where ``train`` holds."""
    rows = docs.where(train & F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("key"))
    counted = saved(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "langid-languages")
    by_lang = {r.lang: r.n for r in counted.collect()}  # the classes of the model
    langs = sorted(by_lang)
    if not langs:
        return Model([], np.zeros((1 << BITS) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0), 1.0)
    wanted = max(sample_rows / len(langs), LEAST_ROWS)
    draw = F.pmod(F.xxhash64("key", "text"), F.lit(1 << 30)) < F.lit(wanted * (1 << 30)) / F.col("n")
    got = saved(rows.where(F.col("text").isNotNull()).join(small(counted), "lang").select("text", "lang", draw.alias("sampled")).mapInArrow(
        _gather, "bucket int, df long, lang string, feats binary, counts binary"), "langid")
    df = np.zeros(1 << BITS)
    for b, n in got.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("df")).collect():
        df[b] = n
    total = sum(by_lang.values())
    idf = np.log((total + 1) / (df + 1)) + 1
    rows, place = [], {x: k for k, x in enumerate(langs)}
    at_most = int(max(sample_rows, LEAST_ROWS * len(langs)) * 5 / 4)
    sample = got.where("feats IS NOT NULL").select("lang", "feats", "counts").orderBy(F.xxhash64("lang", "feats", "counts"), "lang", "feats", "counts")
    for r in sample.limit(at_most).collect():
        at, c = np.frombuffer(r.feats, np.uint32), np.frombuffer(r.counts, np.uint32)
        if len(at):
            rows.append((at, SCALE * idf[at] * c / c.sum(), place[r.lang]))
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))  # the order in which tasks ended must not matter
    held = rows[::5] if len(rows) >= 25 else []
    w = _ftrl([r for k, r in enumerate(rows) if not held or k % 5], len(langs))
    logits = np.array([x @ w[at] + w[-1] for at, x, _ in held]).reshape(len(held), len(langs))
    t = _temperature(logits, np.array([y for *_, y in held], dtype=int))
    bucket, of = np.nonzero(w[:-1])
    values = (w[bucket, of] * idf[bucket] * SCALE).astype(np.float32)
    return Model(langs, np.searchsorted(bucket, np.arange((1 << BITS) + 1)), of.astype(np.int32), values, w[-1].astype(float), t)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``lang_pred`` and ``score`` for every row of ``docs``."""
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(model)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            known = np.array([bool(model.langs) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            logits, n = np.zeros((len(texts), max(1, len(model.langs)))), np.zeros(len(texts))
            if model.langs:
                for i, b in ngrams.blocks([t.lower() if k else "" for t, k in zip(texts, known)], ORDERS, BITS):
                    logits[i] += sums.of(b)
                    n[i] += len(b)
                logits = logits / np.maximum(n, 1)[:, None] + model.bias
            p = _softmax(logits / model.temperature)
            best = p.argmax(axis=1)
            names = [model.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            score = np.where(known, p[np.arange(len(texts)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(names, pa.string()), pa.array(score)],
                                             [*keep, "lang_pred", "score"])

    return docs.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
