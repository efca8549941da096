"""What one task of a build sorts stays bounded: big shards are cut into ranges by themselves."""

from conftest import lines_df
from pyspark.sql import functions as F

from shardload.plans import build, publish
from shardload.plans.build import shard_docs
from shardload.plans.publish import read_current, read_current_part
from shardload.streaming import publish as stream

LINES = [f"{k}\ta:{k}:long,s:w{k % 7} x" for k in range(400)]


def order_of(docs):
    rows = docs.select("shard_id", "_id", F.spark_partition_id().alias("p")).collect()
    return [(r.shard_id, r._id) for r in rows], rows


def test_a_shard_of_many_bytes_is_cut_without_being_told(spark, monkeypatch):
    whole, _ = order_of(shard_docs(lines_df(spark, LINES), "i", "t", shards=2))
    monkeypatch.setattr(build, "RANGE_BYTES", 1000)
    cut, rows = order_of(shard_docs(lines_df(spark, LINES), "i", "t", shards=2))
    assert cut == whole  # partitions follow one another in the order of the shards
    sizes = {p: sum(r.p == p for r in rows) for p in {r.p for r in rows}}
    assert len(sizes) > 6 and max(sizes.values()) < 200


def test_small_shards_stay_one_partition(spark):
    assert shard_docs(lines_df(spark, LINES), "i", "t", shards=3).rdd.getNumPartitions() == 3


def test_side_tables_have_ranges_by_their_documents(spark, monkeypatch, scratch):
    monkeypatch.setattr(publish, "DOCS_PER_RANGE", 20)
    publish.publish(shard_docs(lines_df(spark, LINES), "i", "t", shards=2), scratch, shards=2, with_postings=True,
                    doc_value_schema={"a": "long"})
    for part in ("doc_values", "postings", "numeric_terms"):
        got = read_current_part(spark, scratch, part).select(F.input_file_name().alias("f")).groupBy("f").count().collect()
        assert len(got) > 6, part
    dv = read_current_part(spark, scratch, "doc_values").select("_id", F.element_at("a", 1).alias("a"))
    assert sorted((r._id, r.a) for r in dv.collect()) == sorted((str(k), k) for k in range(400))


def test_a_merge_of_runs_is_cut_by_bytes(spark, monkeypatch, scratch):
    monkeypatch.setattr(stream, "MERGE_BYTES", 8000)
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    for epoch, odd in enumerate((0, 1)):
        stream.apply_batch(lines.where(F.substring_index("value", "\t", 1).cast("int") % 2 == odd), scratch, epoch, "i", "t", shards=2, merge_at=2)
    files = read_current_part(spark, scratch, "files").collect()
    assert len(files) > 6 and sum(f.n_rows for f in files) == 400
    assert sorted(int(r._id) for r in read_current(spark, scratch).collect()) == list(range(400))
