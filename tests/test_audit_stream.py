"""Audit rules on small logs, statistics, and the streaming ingest."""

import os


from conftest import SF001
from shardload.operators.audit import index_readiness, shard_readiness, transfer_acceptance
from shardload.operators.stats import duplicate_ids, field_stats
from shardload.plans.build import parsed_docs
from shardload.sources.tables import orders_lines
from shardload.streaming.ingest import ingest_stream

LOG_SCHEMA = "build_id int, index string, shard_id int, host string, is_primary boolean, ok boolean"


def test_accept_rule(spark):
    rows = [
        (1, "i", 0, "p", True, True), (1, "i", 0, "r1", False, True), (1, "i", 0, "r2", False, False),
        (1, "i", 1, "p", True, False), (1, "i", 1, "r1", False, True),
        (1, "i", 2, "p", True, True), (1, "i", 2, "r1", False, False),
        (1, "i", 3, "p", True, True),
        (1, "i", 4, "p", True, True), (1, "i", 4, "p", True, True), (1, "i", 4, "r1", False, True),
    ]
    got = {r["shard_id"]: r["status"] for r in transfer_acceptance(spark.createDataFrame(rows, LOG_SCHEMA)).collect()}
    assert got == {0: "partial", 1: "failed", 2: "failed", 3: "accepted", 4: "accepted"}


def test_readiness(spark):
    schema = "ts int, index string, shard_id int, role string, host string, assigned boolean, active boolean"
    rows = [(1, "i", 0, "primary", "a", True, True), (1, "i", 0, "replica", "b", True, True),
            (1, "i", 0, "replica", "c", True, False), (1, "i", 1, "primary", "a", True, True),
            (1, "i", 2, "primary", "a", True, True), (1, "i", 2, "replica", "b", False, True),
            (2, "i", 0, "primary", "a", True, True)]
    df = spark.createDataFrame(rows, schema)
    s = {(r["ts"], r["shard_id"]): (r["ready"], r["replica_hosts"]) for r in shard_readiness(df).collect()}
    assert s == {(1, 0): (True, "b"), (1, 1): (True, ""), (1, 2): (False, ""), (2, 0): (True, "")}
    i = {r["ts"]: r["ready"] for r in index_readiness(df).collect()}
    assert i == {1: False, 2: True}


def test_field_stats_and_duplicates(spark):
    from conftest import lines_df
    from shardload.sources.lines import keyed_lines
    from shardload.operators.fields import parse_docs
    docs = parse_docs(keyed_lines(lines_df(spark, ["a\tx:1:integer,x:1:integer,x:2:integer", "a\tx:5:integer",
                                                     "b\ty:s"])))
    st = {r["name"]: r for r in field_stats(docs).collect()}
    assert (st["x"]["max_doc"], st["x"]["doc_count"], st["x"]["sum_doc_freq"], st["x"]["sum_total_term_freq"]) == (3, 2, 3, 4)
    assert (st["x"]["min_l"], st["x"]["max_l"], st["x"]["min_d"]) == (1, 5, None)
    assert [(r["_id"], r["n_docs"]) for r in duplicate_ids(docs).collect()] == [("a", 2)]


def test_stream_ingest_matches_batch(spark, scratch):
    src = os.path.join(scratch, "src")
    orders_lines(spark, SF001).select("value").repartition(3).write.text(src)
    out, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")
    q = ingest_stream(spark, src, out, ck, index="orders", shards=5)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == 1500
    batch = parsed_docs(orders_lines(spark, SF001), shards=5).select("_id", "shard_id")
    assert got.select("_id", "shard_id").exceptAll(batch).count() == 0
