"""Registered queries over the smallest tables, and the pipeline stage by stage."""

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from shardload.llm import decontamination, line_dedup, near_dedup
from shardload.llm.queries import ORACLES, QUERIES
from test_decontamination import brute as contaminated
from test_line_dedup import by_hand
from test_near_dedup import brute as groups

SF = "/root/testdata/sf0.001"


def test_thirteen_queries():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    rel = con.sql(ORACLES[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    want = rel.project(", ".join(f'"{c}"' for c in cols)).fetchall()
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(want, key=str)


def test_pipeline(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        before = docs.collect()
        out.write.parquet(f"{scratch}/{name}")
        out = spark.read.parquet(f"{scratch}/{name}")
        after = out.collect()
        kept[name] = len(after)
        if name != "packing":
            assert out.columns == docs.columns
        ids = sorted(r.doc_id for r in after)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            got = set(ids)
            right = [(r.doc_id in got) == bool(labels[r.doc_id]) for r in before if r.doc_id in labels]
            assert np.mean(right) > 0.9
        elif name == "line_dedup":
            want = by_hand([(r.source, r.text) for r in before], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
            assert {r.doc_id: (r.text, r.n_chars) for r in after} == {r.doc_id: (t, len(t)) for r, t in zip(before, want)}
        elif name == "near_duplicates":
            want = groups([(r.doc_id, r.text) for r in before], near_dedup.PERCENT)
            assert ids == sorted(d for d, n, _, keep in want if keep or not n)
        elif name == "decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = contaminated([(r.doc_id, r.text) for r in before], bench)
            assert ids == sorted({r.doc_id for r in before} - {d for d, _ in bad}) and decontamination.SIMILARITY == 0.8
        else:
            assert sum(r.length for r in after) == sum({r.doc_id: r.doc_tokens for r in after}.values())
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
        docs = out
    assert all(kept.values())
