"""The batch parse and the batch sums: Java's number rules, and no higher-order function for each column of a line."""

import math

import pyarrow as pa
import pytest
from conftest import lines_df
from pyspark.sql import functions as F

from shardload.functions.field_parse import _real, _whole, fields_of
from shardload.operators.fields import infer_fields
from shardload.operators.stats import field_states, field_stats
from shardload.plans.build import parsed_docs


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parse_and_sums_run_by_batches(spark):
    docs = parsed_docs(lines_df(spark, ["1\ta:1:integer,b"]), shards=2)
    for df in (docs, infer_fields(docs), field_states(docs)):
        assert "transform(" not in plan(df) and "array_distinct" not in plan(df)


@pytest.mark.parametrize("text,double,single", [
    ("1d", 1.0, 1.0), (" .5\t", 0.5, 0.5), ("0x1.8p1", 3.0, 3.0), ("1e400", math.inf, math.inf), ("-1e39", -1e39, -math.inf),
    ("16777217.0000000001", 16777217.0, 16777218.0), ("16777216.9999999999", 16777217.0, 16777216.0),
    ("3.4028235677973366e38", 3.4028235677973366e38, 3.4028234663852886e38), ("NaN\n", math.nan, math.nan),
    ("inf", None, None), ("1_0", None, None), ("١", None, None), ("", None, None), ("0xp3", None, None)])
def test_reals_as_java_reads_them(text, double, single):
    same = lambda a, b: a is b or a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    assert same(_real(text, False), double) and same(_real(text, True), single)


def test_integers_as_java_reads_them():
    assert [_whole(t, 16) for t in ("+5", "007", "-32768", "32768", "1\r\n", " 1", "1.0", "")] == [5, 7, -32768, None, 1, None, None, None]
    assert _whole("0" * 30 + "12", 32) == 12


def test_one_bad_value_leaves_the_others_of_its_batch():
    rows = fields_of(pa.array(["a:1:integer,a:x:integer,b:0.5:double", None, "", "\t", "b:1e5:double,:::"]), "\t").to_pylist()
    assert [(f["i"], f["d"], f["error"]) for f in rows[0]] == [(1, None, None), (None, None, "bad_integer"), (None, 0.5, None)]
    assert rows[1] is None and [f["name"] for f in rows[2]] == ["col_"] and rows[3] == []
    assert [(f["d"], f["error"]) for f in rows[4]] == [(1e5, None), (None, "malformed")]


def test_sums_by_hand(spark):
    lines = ["1\tx:1:integer,x:1:integer,x:2:integer,y:-0.0:double,y:0.0:double,y:NaN:double", "2\tx:1:integer,x:a,t", "3\t"]
    docs = parsed_docs(lines_df(spark, lines).unionByName(lines_df(spark, ["4\tx:7:integer"]).withColumn("_doc", F.lit(99).cast("long"))), shards=2)
    got = {(r.name, r.type): r for r in field_stats(docs).collect()}
    x, y = got["x", "integer"], got["y", "double"]
    assert (x.max_doc, x.doc_count, x.sum_doc_freq, x.sum_total_term_freq, x.min_l, x.max_l, x.min_d) == (3, 3, 4, 5, 1, 7, None)
    assert (y.doc_count, y.sum_doc_freq, y.sum_total_term_freq, y.min_d) == (1, 3, 3, 0.0) and math.isnan(y.max_d)
    assert {(r.name, r.type): (r.docs, r.n_values) for r in infer_fields(docs).collect()} == {
        ("x", "integer"): (3, 5), ("x", "string"): (1, 1), ("y", "double"): (1, 3), ("col_t", "integer"): (1, 1)}
