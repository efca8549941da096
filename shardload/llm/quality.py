"""Quality classifier: naive Bayes support vectors (character n-grams of
orders 1 to 3, and bigrams that say a word twice).

N-gram indicators are scaled by class log-count ratios, then a linear
hinge-loss model is fitted by dual coordinate descent; a logistic curve over the
margins of rows it has not seen turns them into probabilities.

The log-count ratios come from every labelled training row.  The linear model is
fitted on a bounded sample of them (``SAMPLE_ROWS`` rows expected, drawn by a hash of id
and text; a quarter more at most, those of least hash); every fifth sampled row is kept for the curve.

Defined results: a null or empty text is scored from the bias alone; if the
training rows lack a class, every score is the share of label 1, counted with
one row more of each class; of repeated labels the mean counts (a tie is 0),
null labels do not; repeated rows are scored each for itself; extra columns pass.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardload.llm import ngrams
from shardload.llm.common import saved, slices, small

ORDERS, BITS = (1, 2, 3), 16
SAMPLE_ROWS = 6000
#: Word bigrams of twice the same word, by their share of a text's bigrams: one indicator per level.
ECHO_LEVELS = (0.0, 0.05, 0.2, 0.4)
FEATURES = (1 << BITS) + len(ECHO_LEVELS)
#: Smoothing of the counts, the cost of a margin error, passes over the sample.
SMOOTH, COST, EPOCHS = 1.0, 1.0, 20
ACCEPT = 0.7


@dataclass
class Model:
    ratio: np.ndarray   # log-count ratio of every bucket
    weights: np.ndarray  # of the scaled indicators
    bias: float
    slope: float        # of the curve over the margins
    offset: float


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class, in how many of a task's rows a bucket occurs; indicators of the sampled rows."""
    count = np.zeros((2, FEATURES), dtype=np.int64)

    def rows(buckets, neg, pos, label, feats):
        return pa.RecordBatch.from_arrays([
            pa.array(buckets, pa.int32()), pa.array(neg, pa.int64()), pa.array(pos, pa.int64()),
            pa.array(label, pa.int32()), pa.array(feats, pa.binary())], ["bucket", "neg", "pos", "label", "feats"])

    for batch in slices(batches):
        labels, sampled = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        keep = []
        for i, at in _indicators(batch.column(0).to_pylist()):
            count[labels[i], at] += 1
            if sampled[i]:
                keep.append((labels[i], at.astype(np.uint32).tobytes()))
        none = [None] * len(keep)
        yield rows(none, none, none, [k for k, _ in keep], [f for _, f in keep])
    at = np.flatnonzero(count.any(axis=0))
    none = [None] * len(at)
    yield rows(at.astype(np.int32), count[0, at], count[1, at], none, none)


def _echoes(text: str | None) -> list[int]:
    words = (text or "").split()
    same = sum(map(operator.eq, words, itertools.islice(words, 1, None)))
    return [(1 << BITS) + k for k, level in enumerate(ECHO_LEVELS) if same > level * (len(words) - 1)] if same else []


def _indicators(texts: list) -> Iterator[tuple[int, np.ndarray]]:
    """The distinct n-gram buckets of every text, in order."""
    seen = np.zeros(FEATURES, dtype=bool)
    last = None
    for i, b in ngrams.blocks(texts, ORDERS, BITS):
        if last is not None and i != last:
            yield last, np.flatnonzero(seen)
            seen[:] = False
        if i != last:
            seen[_echoes(texts[i])] = True
        last = i
        seen[b] = True
    if last is not None:
        yield last, np.flatnonzero(seen)


def _margin(model: Model, at: np.ndarray) -> float:
    r = model.ratio[at]
    return float(r @ model.weights[at]) / max(float(np.sqrt(r @ r)), 1e-9) + model.bias


def _dual_descent(rows: list, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge loss with a box of COST; the bias is the weight of a constant 1."""
    w, bias = np.zeros(len(ratio)), 0.0
    x = []
    for at, _ in rows:
        r = ratio[at]
        x.append(r / max(np.sqrt(r @ r), 1e-9))
    alpha, order = np.zeros(len(rows)), np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            at, y = rows[k][0], 2 * rows[k][1] - 1
            g = y * (x[k] @ w[at] + bias) - 1
            new = min(max(alpha[k] - g / 2, 0.0), COST)  # |x|^2 is 1, and 1 for the constant
            step = (new - alpha[k]) * y
            alpha[k] = new
            if step:
                w[at] += step * x[k]
                bias += step
    return w, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton steps, targets drawn in by one row a class)."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    ab = np.array([1.0, np.log((pos + 1) / (neg + 1))])
    a = np.stack([margins, np.ones(len(y))], axis=1)
    loss = lambda v: (np.logaddexp(0, a @ v) - target * (a @ v)).sum() + 1e-3 * v @ v
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ ab))
        h = (a * (p * (1 - p))[:, None]).T @ a + 2e-3 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (p - target) + 2e-3 * ab)
        size = 1.0
        while loss(ab - size * step) > loss(ab) and size > 1e-4:
            size /= 2
        ab = ab - size * step
    return float(ab[0]), float(ab[1])


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns ``label`` of ``labels`` from the texts of the rows of ``docs`` where ``train`` holds."""
    marks = small(saved(labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
                        .groupBy(F.col(doc_id).alias("__id")).agg((F.avg(label) > 0.5).cast("int").alias("__label")),
                        "labels"), 2_000_000)
    rows = docs.where(train).select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(marks, "__id")
    n = [0, 0]
    for r in rows.groupBy("__label").count().collect():
        n[r["__label"]] = r["count"]
    share_of_1 = (n[1] + 1) / (sum(n) + 2)
    zero = np.zeros(FEATURES)
    if not min(n):
        return Model(zero, zero, 0.0, 0.0, float(np.log(share_of_1 / (1 - share_of_1))))
    # by id and text: rows that share an id do not all come together
    picked = F.pmod(F.xxhash64("__id", "__text"), F.lit(1 << 30)) < int(min(1.0, sample_rows / sum(n)) * (1 << 30))
    got = saved(rows.select("__text", "__label", picked.alias("sampled")).mapInArrow(
        _gather, "bucket int, neg long, pos long, label int, feats binary"), "quality")
    count = np.zeros((2, FEATURES))
    for b, neg, pos in got.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("neg"), F.sum("pos")).collect():
        count[:, b] = neg, pos
    neg, pos = count + SMOOTH
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    sample = [(np.frombuffer(r.feats, np.uint32), r.label) for r in
              got.where("feats IS NOT NULL").select("label", "feats").orderBy(F.xxhash64("label", "feats"), "label", "feats")
              .limit(sample_rows * 5 // 4).collect()]
    sample.sort(key=lambda r: (r[1], len(r[0]), r[0].tobytes()))  # the order in which tasks ended must not matter
    held = sample[::5] if len(sample) >= 50 else sample
    w, bias = _dual_descent([r for k, r in enumerate(sample) if held is sample or k % 5], ratio)
    model = Model(ratio, w, bias, 1.0, 0.0)
    model.slope, model.offset = _curve(np.array([_margin(model, at) for at, _ in held]),
                                       np.array([y for _, y in held]))
    return model


def _scores(texts: list, model: Model) -> np.ndarray:
    margins = np.full(len(texts), model.bias)
    for i, at in _indicators(texts):
        margins[i] = _margin(model, at)
    return 1 / (1 + np.exp(-np.clip(model.slope * margins + model.offset, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``score`` (0 to 1, higher: label 1 likelier) of every row of ``docs``."""
    schema = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = _scores(batch.column(0).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s)], [*keep, "score"])

    return docs.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``accept``, all columns unchanged."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_scores(batch.column(at).to_pylist(), model) >= accept))

    return docs.mapInArrow(run, docs.schema)
