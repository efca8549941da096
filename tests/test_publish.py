"""Sharded write, staged publish, verification, pruning, bulk lines, CLI."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from shardload.operators.predicates import get_by_id, shard_for
from shardload.operators.routing import route
from shardload.operators.stats import manifest
from shardload.plans.build import shard_docs
from shardload.plans.publish import (bulk_lines, current_build, publish, read_current, unpublish,
                                     verify_publish, write_sharded)
from shardload.sources.tables import orders_lines


def test_write_one_file_per_shard_in_order(spark, scratch):
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    path = os.path.join(scratch, "w")
    write_sharded(docs, path)
    dirs = sorted(d for d in os.listdir(path) if d.startswith("shard_id="))
    assert dirs == [f"shard_id={i}" for i in range(5)]
    for d in dirs:
        files = [f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")]
        assert len(files) == 1
        ids = [r["_id"] for r in spark.read.parquet(os.path.join(path, d, files[0])).select("_id").collect()]
        assert ids == sorted(ids, reverse=True)
    back = spark.read.parquet(path)
    assert back.count() == 1500
    rerouted = route(back.select("_id", F.col("shard_id").alias("written")), 5)
    assert rerouted.where(F.col("shard_id") != F.col("written")).count() == 0
    with pytest.raises(Exception):
        write_sharded(docs, path)           # refuses to overwrite


def test_publish_swap_and_drop(spark, scratch):
    root = os.path.join(scratch, "ds")
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    b1 = publish(docs, root, build_id="b1")
    assert current_build(spark, root) == "b1"
    b2 = publish(docs, root, build_id="b2", shards=5)
    assert current_build(spark, root) == "b2" and b1 != b2
    live = read_current(spark, root)
    v = verify_publish(manifest(live, b2), live).collect()
    assert len(v) == 5 and all(r["ok"] for r in v)
    unpublish(spark, root)
    assert current_build(spark, root) is None


def test_failed_verification_keeps_old_build(spark, scratch):
    root = os.path.join(scratch, "ds2")
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    publish(docs, root, build_id="good")
    expected = manifest(docs, "x")
    short = spark.read.parquet(os.path.join(root, "builds", "good")).where(F.col("shard_id") != 2)
    v = {r["shard_id"]: r for r in verify_publish(expected, short).collect()}
    assert not v[2]["ok"] and v[2]["found"] == 0 and v[0]["ok"]
    assert current_build(spark, root) == "good"


def test_get_by_id_prunes_partitions(spark, scratch):
    root = os.path.join(scratch, "ds3")
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    publish(docs, root, build_id="b")
    live = read_current(spark, root)
    q = get_by_id(live, "42", 5)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_id" in plan and f"(shard_id#" in plan
    rows = q.collect()
    assert len(rows) == 1 and rows[0]["shard_id"] == shard_for("42", 5)


def test_bulk_lines(spark):
    docs = shard_docs(lines_df(spark, ["7\ta:1:integer,b:x"]), "i", "t", shards=5)
    r = bulk_lines(docs, "i", "t").collect()[0]
    action, source = r["bulk"].split("\n")
    assert action == '{"index":{"_index":"i","_type":"t","_id":"7"}}'
    assert source == '{"a":1,"b":"x"}'


def test_cli_import(spark, scratch):
    from shardload.cli import main
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.txt"), "w") as f:
        f.write("a\tx:1:integer,x:2:integer\nb\tx:bad:integer\nc\ty:z\nshort\n")
    root = os.path.join(scratch, "out")
    rej = os.path.join(scratch, "rej")
    build = main(["import", "--input", src, "--output", root, "--index", "ix", "--shards", "3",
                  "--on-error", "reject", "--rejects", rej, "--doc-values", "x:integer,y:string", "--postings",
                  "--source-dup", "array"], spark=spark)
    live = read_current(spark, root)
    assert sorted(r["_id"] for r in live.collect()) == ["a", "c"]
    assert [r["_id"] for r in spark.read.parquet(rej).collect()] == ["b"]
    assert main(["current", "--output", root], spark=spark) == build
    from shardload.plans.publish import read_current_part
    dv = {r["_id"]: (r["x"], r["y"]) for r in read_current_part(spark, root, "doc_values").collect()}
    assert dv == {"a": ([1, 2], []), "c": ([], ["z"])}
    src = {r["_id"]: r["_source"] for r in live.collect()}
    assert src["a"] == '{"x":[1,2]}' 
    post = [(r["field"], r["term"], r["_id"], r["tf"]) for r in read_current_part(spark, root, "postings").collect()]
    assert post == [("y", "z", "c", 1)]
    assert read_current_part(spark, root, "manifest").count() >= 1


def test_source_parses_back_to_fields(spark):
    import json
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    for r in docs.select("_source", "fields").collect():
        src = json.loads(r["_source"])
        want = {}
        for f in r["fields"]:
            want[f["name"]] = next(f[k] for k in ("str", "i", "l", "s", "f", "d") if f[k] is not None)
        assert src == want


def test_write_bulk_and_cli_drop(spark, scratch):
    import json
    from shardload.cli import main
    from shardload.plans.publish import write_bulk
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    path = os.path.join(scratch, "bulk")
    write_bulk(docs, path, "orders", "order")
    text = spark.read.text(path)
    assert text.count() == 2 * 1500                      # action line + source line per document
    first = [r["value"] for r in text.limit(2).collect()]
    assert json.loads(first[0])["index"]["_index"] == "orders"
    root = os.path.join(scratch, "dropme")
    publish(docs, root, build_id="x", shards=5)
    main(["drop", "--output", root], spark=spark)
    assert current_build(spark, root) is None
    assert not os.path.exists(os.path.join(root, "builds", "x"))


def test_cli_fail_mode_publishes_nothing(spark, scratch):
    from shardload.cli import main
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "p.txt"), "w") as f:
        f.write("a\tx:1:integer\nb\tx:bad:integer\n")
    root = os.path.join(scratch, "out")
    with pytest.raises(Exception):
        main(["import", "--input", src, "--output", root, "--index", "ix", "--on-error", "fail"], spark=spark)
    assert current_build(spark, root) is None
