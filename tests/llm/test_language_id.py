import numpy as np
from pyspark.sql import functions as F

from shardload.llm import language_id, ngrams
from shardload.llm.common import id_bucket

SF01 = "/root/testdata/sf0.01"


def test_ngrams_of_long_texts_equal_those_of_short_ones(monkeypatch):
    texts = ["abcdefghij" * 30 + "xyz", "", None, "a", "ab" * 40, "q" * 64, "q" * 65, "q" * 66, "q" * 67]
    whole = {}
    for i, b in ngrams.blocks(texts, (1, 2, 3), 16):
        assert i not in whole
        whole[i] = np.sort(b)
    for size in (7, 64):
        monkeypatch.setattr(ngrams, "BLOCK", size)
        cut = {}
        for i, b in ngrams.blocks(texts, (1, 2, 3), 16):
            cut.setdefault(i, []).append(b)
        assert all(np.array_equal(np.sort(np.concatenate(v)), whole[i]) for i, v in cut.items()) and set(cut) == set(whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    held = id_bucket(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs, ~held)
    got = language_id.predict(docs.where(held).select("doc_id", "text", "lang"), model, keep=("doc_id", "lang")).collect()
    right = [r.lang == r.lang_pred for r in got]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and len(model.values) < 0.5 * 4 * (1 << language_id.BITS)  # sparse
    confidence = np.mean([r.score for r in got])
    assert abs(confidence - np.mean(right)) < 0.05  # calibrated


def test_edges(edge_docs, no_docs):
    model = language_id.fit(edge_docs, F.lit(True))
    got = language_id.predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and set(model.langs) == {"en", "fr"}
    for r in got:
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 6)) or r.doc_id is None
    none = language_id.fit(no_docs, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(edge_docs, none).collect()} == {"und"}
    assert language_id.predict(no_docs, model).count() == 0


def many(n_langs, rows_each):
    """Languages of syllables of their own, one of them a third of all rows."""
    import random
    rnd = random.Random(5)
    rows = []
    for k in range(n_langs):
        own = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(12)]
        for _ in range(rows_each * (n_langs // 2 if k == 0 else 1)):
            rows.append((len(rows), " ".join(rnd.choice(own) for _ in range(25)), f"x{k:02d}"))
    return rows


def test_every_language_is_learned(spark):
    """80 languages: none is left out, and the weights laid out sparsely give what the full ones give."""
    rows = many(80, 12)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    held = F.col("doc_id") % 6 == 0
    model = language_id.fit(docs, ~held)
    assert len(model.langs) == 80 and len(np.unique(model.of)) == 80
    test = docs.where(held)
    got = {r.doc_id: r for r in language_id.predict(test, model).collect()}
    right = [got[i].lang_pred == lang for i, _, lang in rows if i in got]
    assert len(right) > 150 and np.mean(right) > 0.97 and {got[i].lang_pred for i in got} >= {f"x{k:02d}" for k in range(40, 80)}
    full = np.zeros((1 << language_id.BITS, 80))
    full[np.repeat(np.arange(1 << language_id.BITS), np.diff(model.edges)), model.of] = model.values
    for i, text, _ in rows[:40]:
        b = np.concatenate([b for _, b in language_id.ngrams.blocks([text], language_id.ORDERS, language_id.BITS)])
        assert np.allclose(language_id._Sums(model).of(b), full[b].sum(axis=0), rtol=1e-4, atol=1e-3)


def test_the_sample_does_not_depend_on_tasks(spark):
    """Repeated ids, more rows drawn than the bound: any deal of the rows gives the same model."""
    rows = [(i % 7 if i % 2 else None, t, x) for i, t, x in many(3, 60)]
    schema = "doc_id long, text string, lang string"
    models = [language_id.fit(spark.createDataFrame(rows[::step], schema).repartition(n), F.lit(True), sample_rows=30)
              for step, n in ((1, 1), (-1, 5))]
    assert np.array_equal(models[0].values, models[1].values) and np.array_equal(models[0].of, models[1].of)
    assert models[0].temperature == models[1].temperature and np.array_equal(models[0].bias, models[1].bias)


def test_margins_against_a_plain_version(spark):
    """A text's score by counting its n-grams one by one."""
    rows = many(4, 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    weight = {}
    for b in range(1 << language_id.BITS):
        for j in range(model.edges[b], model.edges[b + 1]):
            weight[b, model.of[j]] = float(model.values[j])
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    for i, text, _ in rows[:15]:
        buckets = [int(x) for _, b in language_id.ngrams.blocks([text], language_id.ORDERS, language_id.BITS) for x in b]
        logit = [sum(weight.get((b, k), 0.0) for b in buckets) / len(buckets) + model.bias[k] for k in range(4)]
        e = np.exp((np.array(logit) - max(logit)) / model.temperature)
        assert got[i].lang_pred == model.langs[int(np.argmax(logit))] and abs(got[i].score - e.max() / e.sum()) < 1e-4
