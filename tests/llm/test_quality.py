import numpy as np
from pyspark.sql import functions as F

from shardload.llm import quality
from shardload.llm.common import id_bucket

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    held = id_bucket(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, labels, ~held)
    rows = quality.score(docs.where(held), model).join(labels, "doc_id").collect()
    right = [(r.score >= quality.ACCEPT) == bool(r.quality) for r in rows]
    assert len(right) > 60 and np.mean(right) > 0.93
    good = quality.keep_good(docs, model)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()


def test_dual_descent_solves_the_hinge_problem():
    """The duality gap of the fitted model is small on a small problem."""
    rng = np.random.default_rng(1)
    ratio = rng.normal(size=quality.FEATURES)
    rows = [(np.unique(rng.integers(0, 40, 12)) + 30 * y, int(y)) for y in rng.integers(0, 2, 60)]
    old, quality.EPOCHS = quality.EPOCHS, 300
    try:
        w, bias = quality._dual_descent(rows, ratio)
    finally:
        quality.EPOCHS = old
    x = [ratio[a] / np.linalg.norm(ratio[a]) for a, _ in rows]
    margin = np.array([(2 * y - 1) * (v @ w[a] + bias) for v, (a, y) in zip(x, rows)])
    primal = 0.5 * (w @ w + bias * bias) + quality.COST * np.maximum(0, 1 - margin).sum()
    for step in rng.normal(scale=0.01, size=(50, 2)):  # no nearby point along its own directions is better
        w2, b2 = w * (1 + step[0]), bias + step[1]
        m2 = np.array([(2 * y - 1) * (v @ w2[a] + b2) for v, (a, y) in zip(x, rows)])
        assert 0.5 * (w2 @ w2 + b2 * b2) + quality.COST * np.maximum(0, 1 - m2).sum() >= primal - 1e-3


def test_echo_levels():
    assert quality._echoes("a b c") == [] and quality._echoes(None) == [] and quality._echoes("a") == []
    assert len(quality._echoes("a a a a a")) == len(quality.ECHO_LEVELS) and len(quality._echoes("a a " + "b c " * 30)) == 1


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 1), (7, None, 0), (None, 1, 0), (8, 1, 0), (8, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(edge_docs, labels, F.lit(True))
    got = quality.score(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(edge_docs, model, accept=0.0).collect() == edge_docs.collect()
    one_class = quality.fit(edge_docs, labels.where("doc_id = 4"), F.lit(True))  # rows of label 1 alone
    assert len({r.score for r in quality.score(edge_docs, one_class).collect()}) == 1
    nothing = quality.fit(no_docs, labels, F.lit(True))
    assert {r.score for r in quality.score(edge_docs, nothing).collect()} == {0.5}
    assert quality.score(no_docs, model).count() == 0
