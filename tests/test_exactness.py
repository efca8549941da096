"""Values, keys and files at the edges: Java number names, -0.0, longs above 2^53, lost files, bad lines."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from shardload.operators.fields import infer_fields, parse_docs
from shardload.operators.postings import analyze_fields, numeric_postings, numeric_terms, postings
from shardload.operators.predicates import exists_, match_term, range_
from shardload.operators.stats import field_stats
from shardload.plans import publish as P
from shardload.plans.build import shard_docs, shard_fields
from shardload.sources.lines import keyed_lines, numbered_lines
from shardload.sources.tables import orders_lines
from shardload.streaming.ingest import ingest_stream


def docs_of(spark, lines, **kw):
    return parse_docs(keyed_lines(lines_df(spark, lines)), **kw)


def test_java_number_names(spark):
    good = ["NaN", "Infinity", "-Infinity", "+Infinity", " NaN ", "1e400", "-0.0"]
    bad = ["inf", "nan", "-INFINITY", "INFINITY", "+Inf", "infinity", "NAN", "none"]
    for typ in ("double", "float"):
        docs = docs_of(spark, [f"{k}\tx:{v}:{typ}" for k, v in enumerate(good + bad)], on_error="reject")
        assert sorted(int(r._id) for r in docs.collect()) == list(range(len(good)))


def test_numbers_stay_exact(spark):
    docs = docs_of(spark, ["a\tl:9007199254740993:long,l:9007199254740992:long,d:-0.0:double,d:0.0:double,d:NaN:double",
                           "b\tl:9007199254740993:long,d:0.0:double"])
    terms = {(r.field, r.whole, str(r.real), r.neg_zero): (r.df, r.ttf) for r in numeric_terms(docs).collect()}
    assert terms == {("l", 9007199254740993, "None", False): (2, 2), ("l", 9007199254740992, "None", False): (1, 1),
                     ("d", None, "-0.0", True): (1, 1), ("d", None, "0.0", False): (2, 2),
                     ("d", None, "nan", False): (1, 1)}
    rows = numeric_postings(docs).where("field = 'd' AND whole IS NULL").collect()
    assert sorted((r._id, r.neg_zero, r.tf) for r in rows) == [("a", False, 1), ("a", False, 1), ("a", True, 1), ("b", False, 1)]
    st = {r.name: r for r in field_stats(docs).collect()}
    assert (st["l"].min_l, st["l"].max_l, st["l"].min_d) == (9007199254740992, 9007199254740993, None)
    assert (st["d"].sum_doc_freq, st["d"].max_doc) == (4, 2)


def test_nan_is_in_no_half_open_range(spark):
    docs = docs_of(spark, ["n\tx:NaN:double", "a\tx:50:double", "b\tx:1:double"])
    ids = lambda **kw: sorted(r._id for r in docs.where(range_("x", "double", **kw)).collect())
    assert ids(lo=45) == ["a"] and ids(hi=45) == ["b"] and ids(lo=0, hi=float("nan")) == ["a", "b", "n"]


def test_positions_go_on_and_stop_words_leave_gaps(spark):
    docs = docs_of(spark, ["1\tc:red fox,c:blue fox,e:the fox", "1\tc:red fox"]).withColumn("shard_id", F.lit(0))
    rows = postings(analyze_fields(docs, stop_words=("the",))).collect()
    got = sorted((r.field, r.term, r._doc, tuple(r.positions)) for r in rows)
    keys = sorted({r._doc for r in rows})
    assert got == sorted([("c", "red", keys[0], (0,)), ("c", "fox", keys[0], (1, 3)), ("c", "blue", keys[0], (2,)),
                          ("e", "fox", keys[0], (1,)), ("c", "red", keys[1], (0,)), ("c", "fox", keys[1], (1,))])


def test_published_postings_tell_equal_ids_apart(spark, scratch):
    root = os.path.join(scratch, "ds")
    lines = lines_df(spark, ["u\tc:red", "u\tc:blue", "v\tc:red"])
    P.publish(shard_docs(lines, "i", shards=2, split=2), root, shards=2, split=2, with_postings=True)
    docs, post = P.read_current(spark, root), P.read_current_part(spark, root, "postings")
    hits = match_term(docs, post, "c", "red").collect()
    assert sorted(r._source for r in hits) == ['{"c":"red"}', '{"c":"red"}'] and sorted(r._id for r in hits) == ["u", "v"]
    assert {r.n_docs for r in P.read_current_part(spark, root, "manifest").collect()} <= {0, 1, 2, 3}
    assert P.read_current_part(spark, root, "manifest").count() == 2


def test_many_fields_in_one_document(spark):
    line = "d\t" + ",".join(f"f{k}:{k}:integer" for k in range(32_000))
    docs = docs_of(spark, [line])
    assert infer_fields(docs).count() == 32_000
    assert field_stats(docs).agg(F.sum("sum_doc_freq")).first()[0] == 32_000


def test_repeated_names_in_a_long_document(spark):
    import json

    from shardload.operators.docs import source_json
    line = "d\t" + ",".join(f"f{k % 5000}:{k}:integer" for k in range(20_000)) + ",z:1"
    row = docs_of(spark, [line]).select(source_json("fields", "last").alias("last"), source_json("fields", "array").alias("all")).first()
    assert list(json.loads(row.last).items()) == [(f"f{k}", 15_000 + k) for k in range(5000)] + [("z", "1")]
    assert list(json.loads(row.all).items()) == [
        (f"f{k}", [k, 5000 + k, 10_000 + k, 15_000 + k]) for k in range(5000)] + [("z", "1")]


def test_exists_compares_names(spark):
    docs = docs_of(spark, ["1\ta.b:x", "2\tab:x", "3\ta:x"])
    ids = lambda f: sorted(r._id for r in docs.where(exists_(f)).collect())
    assert ids("a") == ["1", "3"] and ids("a.b") == ["1"] and ids("_source") == ["1", "2", "3"] and ids("b") == []


def test_bad_values_fail_by_default(spark):
    with pytest.raises(Exception, match="bad field value in document b"):
        shard_docs(lines_df(spark, ["a\tx:1:integer", "b\tx:y:integer"]), "i", shards=2).collect()


def test_reject_mode_loses_nothing(spark, scratch):
    root = os.path.join(scratch, "ds")
    lines = lines_df(spark, ["a\tx:1:integer", "b\tx:y:integer,z:1:short,w:q:short", "c\tx:2:integer", "short"])
    P.publish(shard_docs(lines, "i", shards=2, on_error="reject"), root, shards=2)
    assert sorted(r._id for r in P.read_current(spark, root).collect()) == ["a", "c"]
    bad = P.read_current_part(spark, root, "rejects").collect()
    assert [(r._id, r.pos, r.token, r.reason) for r in sorted(bad, key=lambda r: r.pos)] == [
        ("b", 0, "x:y:integer", "bad_integer"), ("b", 2, "w:q:short", "bad_short")]
    m = P.read_current_part(spark, root, "manifest").collect()
    assert sum(r.n_docs for r in m) == 2 and sum(r.n_rejected for r in m) == 1


def test_a_lost_file_fails_the_publish(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "ds")
    docs = shard_docs(orders_lines(spark, SF001), "orders", shards=5)
    P.publish(docs, root, build_id="good", shards=5)
    write = P.write_sharded

    def lossy(docs, path, **kw):
        write(docs, path, **kw)
        folder = os.path.join(path, "shard_id=3")
        os.rename(folder, os.path.join(scratch, "gone"))

    monkeypatch.setattr(P, "write_sharded", lossy)
    with pytest.raises(IOError, match="failed verification"):
        P.publish(docs, root, build_id="bad", shards=5)
    assert P.current_build(spark, root) == "good" and P.read_current(spark, root).count() == 1500
    assert sorted(os.listdir(os.path.join(root, "builds"))) == ["good", "good_manifest"]


def test_arguments_are_checked_first(spark, scratch):
    root = os.path.join(scratch, "ds")
    docs = shard_docs(orders_lines(spark, SF001), "orders", shards=5)
    with pytest.raises(ValueError, match="bool"):
        P.publish(docs, root, doc_value_schema={"x": "bool"})
    assert not os.path.exists(root)


def test_a_failing_side_table_leaves_no_debris(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "ds")
    monkeypatch.setattr(P, "write_postings", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        P.publish(shard_docs(orders_lines(spark, SF001), "orders", shards=5), root, shards=5, with_postings=True)
    assert os.listdir(os.path.join(root, "builds")) == [] and P.current_build(spark, root) is None


def test_meta_file_import(spark, scratch):
    from shardload.cli import main
    src, meta = os.path.join(scratch, "in.txt"), os.path.join(scratch, "meta")
    with open(src, "w") as f:
        f.write("a\t1\tx\nb\tbad\ty\nc\t3\n")
    with open(meta, "w") as f:
        f.write("n:integer,s:string\n")
    root = os.path.join(scratch, "out")
    main(["import", "--input", src, "--output", root, "--index", "i", "--shards", "2", "--meta", meta,
          "--on-error", "reject"], spark=spark)
    live = {r._id: r._source for r in P.read_current(spark, root).collect()}
    assert live == {"a": '{"n":1,"s":"x"}', "c": '{"n":3}'}
    assert [(r._id, r.token) for r in P.read_current_part(spark, root, "rejects").collect()] == [("b", "bad")]
    keyed = keyed_lines(lines_df(spark, ["a\t1\tx"]))
    assert shard_fields(keyed, "i", shards=2, meta="n:long").first()._source == '{"n":1}'


def test_line_numbers_do_not_depend_on_splits(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for name, n in (("a.txt", 3000), ("b.txt", 10)):
        with open(os.path.join(src, name), "w") as f:
            f.write("".join(f"{k}\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ids = []
    try:
        for size in ("1000", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = numbered_lines(spark, src)
            assert lines.where(F.col("value").cast("long") != F.col("_line")).isEmpty() and lines.count() == 3010
            ids.append(sorted(r._id for r in keyed_lines(lines, auto_id=True).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids[0] == ids[1] and len(set(ids[0])) == 3010


def test_stream_keys_and_bad_lines(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    for k in range(2):
        with open(os.path.join(src, f"{k}.txt"), "w") as f:
            f.write(f"u\tx:{k}:integer\nw{k}\tx:bad:integer\n")
    out = os.path.join(scratch, "out")
    ingest_stream(spark, src, out, os.path.join(scratch, "ck"), index="i", shards=2, max_files_per_trigger=1,
                  on_error="reject").awaitTermination(300)
    rows = spark.read.parquet(out)
    assert rows.count() == 4 and rows.select("_doc").distinct().count() == 4
    assert rows.where("_bad IS NOT NULL").count() == 2
    with pytest.raises(Exception):
        ingest_stream(spark, src, os.path.join(scratch, "o2"), os.path.join(scratch, "c2"), index="i",
                      shards=2).awaitTermination(300)


def test_bulk_is_placed(spark, scratch):
    from shardload.plans.build import parsed_docs
    path = os.path.join(scratch, "bulk")
    docs = parsed_docs(orders_lines(spark, SF001).repartition(6), shards=3)
    P.write_bulk(docs, path, "orders", "order", shards=3)
    for k in range(3):
        assert len([f for f in os.listdir(os.path.join(path, f"shard_id={k}")) if f.endswith(".txt")]) == 1
