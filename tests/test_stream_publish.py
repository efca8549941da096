"""Micro-batches that go live: ledger, replay, merging, failures."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from shardload.operators.routing import java_order_key
from shardload.plans.files import documents_by_id, verify_build
from shardload.plans.publish import current_build, publish, read_current, read_current_part, unpublish
from shardload.plans.build import shard_docs
from shardload.plans.search import Term, search
from shardload.streaming import publish as S


def lines_of(spark, epoch, n=40):
    return lines_df(spark, [f"id{k % 17}-{epoch}\tx:{k}:integer,t:word{k % 3} epoch{epoch}" for k in range(n)]).select("value")


def test_batches_become_one_dataset(spark, scratch):
    root = os.path.join(scratch, "ds")
    sizes = []
    for epoch in range(6):
        assert S.apply_batch(lines_of(spark, epoch), root, epoch, "ix", shards=3, merge_at=3, with_postings=True)
        state = S.snapshot(spark, root)
        sizes.append(len(state["runs"]))
        live = read_current(spark, root)
        assert live.count() == 40 * (epoch + 1) == live.select("_doc").distinct().count() == sum(state["rows"].values())
        assert verify_build(spark, root).count() == 0
    assert sizes == [1, 2, 1, 2, 3, 2]
    assert sum(r.n_docs for r in read_current_part(spark, root, "manifest").collect()) == 240
    merged = [r for r in state["runs"] if r.startswith("m-")][0]
    rows = spark.read.parquet(os.path.join(root, "builds", merged)).select(
        "shard_id", "_id", F.hex(java_order_key(F.col("_id"))).alias("k"), F.col("_metadata.file_name").alias("f"),
        F.col("_metadata.row_index").alias("i")).orderBy("shard_id", "f", "i").collect()
    for s in range(3):
        keys = [r.k for r in rows if r.shard_id == s]
        assert keys == sorted(keys, reverse=True)
    # the index and the look-ups see all runs
    assert search(spark, root, Term("t", "epoch4")).count() == 40
    assert search(spark, root, Term("t", "word1"), Term("t", "epoch0")).count() == 13
    assert documents_by_id(spark, root, ["id3-0", "id3-5"]).count() == 6


def test_a_replay_changes_nothing(spark, scratch):
    root = os.path.join(scratch, "ds")
    for epoch in range(2):
        S.apply_batch(lines_of(spark, epoch), root, epoch, "ix", shards=2)
    before, files = current_build(spark, root), sorted(os.listdir(os.path.join(root, "builds")))
    assert not S.apply_batch(lines_of(spark, 1), root, 1, "ix", shards=2)
    assert current_build(spark, root) == before and sorted(os.listdir(os.path.join(root, "builds"))) == files
    with pytest.raises(ValueError, match="other lines"):
        S.apply_batch(lines_of(spark, 9), root, 1, "ix", shards=2)
    assert current_build(spark, root) == before


def test_a_failed_batch_leaves_the_dataset_and_can_come_again(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "ds")
    S.apply_batch(lines_of(spark, 0), root, 0, "ix", shards=2)
    before = current_build(spark, root)
    with pytest.raises(Exception, match="bad field value"):
        S.apply_batch(lines_df(spark, ["a\tx:1:integer", "b\tx:bad:integer"]).select("value"), root, 1, "ix", shards=2)
    commit = S._commit
    monkeypatch.setattr(S, "_commit", lambda *a: (_ for _ in ()).throw(IOError("lost")))
    with pytest.raises(IOError):
        S.apply_batch(lines_of(spark, 1), root, 1, "ix", shards=2)
    monkeypatch.setattr(S, "_commit", commit)
    assert current_build(spark, root) == before and read_current(spark, root).count() == 40
    assert S.apply_batch(lines_of(spark, 1), root, 1, "ix", shards=2) and read_current(spark, root).count() == 80
    gone = S.vacuum(spark, root)
    assert len(gone) == 2 and read_current(spark, root).count() == 80 and verify_build(spark, root).count() == 0
    assert S.vacuum(spark, root) == []


def test_rejected_and_dropped_lines(spark, scratch):
    root = os.path.join(scratch, "ds")
    options = dict(shards=2, on_error="reject", merge_at=2)
    assert S.apply_batch(lines_df(spark, ["no cells"]).select("value"), root, 0, "ix", **options)
    assert S.snapshot(spark, root)["runs"] == []
    assert S.apply_batch(lines_df(spark, []).select("value"), root, 1, "ix", **options)
    S.apply_batch(lines_df(spark, ["a\tx:1:integer", "b\tx:bad:integer"]).select("value"), root, 2, "ix", **options)
    S.apply_batch(lines_df(spark, ["c\tx:no:integer", "d\tx:2:integer"]).select("value"), root, 3, "ix", **options)
    assert len(S.snapshot(spark, root)["runs"]) == 1  # merged, the rejected documents with the others
    assert sorted(r["_id"] for r in read_current(spark, root).collect()) == ["a", "d"]
    assert sorted(r["_id"] for r in read_current_part(spark, root, "rejects").collect()) == ["b", "c"]
    unpublish(spark, root)
    assert current_build(spark, root) is None and S.vacuum(spark, root)


def test_a_stream_goes_on_from_a_batch_build(spark, scratch):
    root = os.path.join(scratch, "ds")
    publish(shard_docs(lines_df(spark, ["a\tx:1:integer"]).withColumn("_doc", F.lit("batch")), "ix", shards=2), root, shards=2)
    S.apply_batch(lines_of(spark, 0), root, 0, "ix", shards=2)
    assert read_current(spark, root).count() == 41


def test_stream_from_files(spark, scratch):
    from shardload.sources.tables import orders_lines
    src, root = os.path.join(scratch, "src"), os.path.join(scratch, "ds")
    orders_lines(spark, SF001).select("value").repartition(3).write.text(src)
    for ck in ("a", "a", "b"):  # the same stream again, then a replay from its start
        S.publish_stream(spark, src, root, os.path.join(scratch, ck), "orders", shards=5, max_files_per_trigger=1,
                         merge_at=2).awaitTermination(600)
        assert read_current(spark, root).select("_id").distinct().count() == read_current(spark, root).count() == 1500
    assert sorted(S.snapshot(spark, root)["epochs"]) == ["0", "1", "2"]


def test_stored_states_equal_a_rescan(spark, scratch):
    from shardload.operators.postings import analyze_fields, postings, term_stats
    from shardload.operators.stats import field_stats, merge_field_states, merge_term_states
    root = os.path.join(scratch, "ds")
    for epoch in range(3):
        S.apply_batch(lines_of(spark, epoch), root, epoch, "ix", shards=4, merge_at=2, with_postings=True, with_stats=True)
    docs = read_current(spark, root)
    fields, terms = (read_current_part(spark, root, p) for p in ("field_stats", "term_stats"))
    for shards in (None, [1], [0, 2, 3], []):
        own = docs if shards is None else docs.where(F.col("shard_id").isin(shards))
        key = lambda df: sorted(map(str, df.collect()))
        assert key(merge_field_states(fields, shards)) == key(field_stats(own))
        want = term_stats(postings(analyze_fields(own, analyzer="standard")))
        assert key(merge_term_states(terms, shards)) == key(want)
