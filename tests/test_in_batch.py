"""Fields are picked in the call that parses them: the same values as over the parsed documents, and bad values still fail."""

import math

import pytest
from conftest import lines_df
from pyspark.sql import functions as F

from shardload.operators.docs import discover_schema, doc_values, to_wide
from shardload.operators.fields import fields_long, infer_fields
from shardload.plans.build import parsed_docs, shard_docs
from shardload.plans.queries import QUERIES

LINES = ["1\tn:3:integer,n:-1:integer,n:3:integer,x:0.0:double,x:NaN:double,x:-0.0:double,x:-1.5:double,s:é,s:z,s:a,s:z", "2\tn:text,s:5:long,x",
         "3\t", "4", "4\ts:é,n:7:integer\tn:8:integer,f:0.1:float,b:9:long,h:-2:short"]
SCHEMA = {"n": "integer", "x": "double", "s": "string", "f": "float", "b": "long", "h": "short", "col_x": "integer", "none": "string"}


def rows(df):
    show = lambda v: [show(x) for x in v] if isinstance(v, list) else "NaN" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted([show(v) for v in r] for r in df.collect())


@pytest.mark.parametrize("make", [
    lambda docs, **kw: to_wide(docs, SCHEMA, **kw), lambda docs, **kw: to_wide(docs, SCHEMA, multi="array", **kw),
    lambda docs, **kw: to_wide(docs, {"_id": "string", "n": "integer"}, keep=("_doc", "shard_id"), **kw),
    lambda docs, **kw: doc_values(docs, SCHEMA, **kw)])
def test_values_of_a_batch_are_those_of_the_documents(spark, make):
    lines = lines_df(spark, LINES)
    got, want = make(parsed_docs(lines, shards=2, in_batch=True), in_batch=True), make(parsed_docs(lines, shards=2))
    assert got.dtypes == want.dtypes and rows(got) == rows(want)


def test_long_form_with_some_members(spark):
    lines, members = lines_df(spark, LINES), ("pos", "name", "type", "i", "s", "f", "d", "str")
    got = fields_long(parsed_docs(lines, shards=2, in_batch=True), keep=("_id",), members=members)
    want = fields_long(parsed_docs(lines, shards=2), keep=("_id",)).select("_id", *members)
    assert got.dtypes == want.dtypes and rows(got) == rows(want)


def test_a_bad_value_fails_and_names_its_document(spark):
    docs = parsed_docs(lines_df(spark, ["ok\ta:1:integer", "empty\t", "odd\tb:x,a:x:integer"]), shards=2, in_batch=True)
    with pytest.raises(Exception, match="bad field value in document odd"):
        to_wide(docs, {"b": "string"}, in_batch=True).collect()
    with pytest.raises(ValueError, match="in_batch"):
        parsed_docs(lines_df(spark, LINES), on_error="null", in_batch=True)


@pytest.mark.parametrize("name", ["q_wide", "q_docvalues_num", "q_docvalues_str", "q_unknown_type", "q_fields_long"])
def test_parsed_fields_do_not_leave_the_batch(spark, name):
    """One Python node for parse and pick, which hands on no whole field (its text ``raw`` and its ``error``)."""
    from conftest import SF001
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    nodes = [x for x in plan.splitlines() if "ArrowEvalPython" in x]
    assert len(nodes) == 1 and nodes[0].count("run(") >= 2 and "exists(" not in plan


def test_picking_from_documents_that_were_parsed_before(spark):
    docs = parsed_docs(lines_df(spark, LINES), shards=2, on_error="null").withColumn("fields", F.when(F.col("_id") != "2", F.col("fields")))
    for kw in ({"multi": "first"}, {"multi": "array"}):
        assert rows(to_wide(docs, SCHEMA, in_batch=True, **kw)) == rows(to_wide(docs, SCHEMA, **kw))
    assert rows(doc_values(docs, SCHEMA, in_batch=True)) == rows(doc_values(docs, SCHEMA))


def test_names_and_types_of_a_batch(spark):
    lines = lines_df(spark, LINES)
    docs, before = parsed_docs(lines, shards=2, in_batch=True), parsed_docs(lines, shards=2)
    assert rows(infer_fields(docs, in_batch=True)) == rows(infer_fields(before))
    assert discover_schema(docs, in_batch=True) == discover_schema(before)
    nodes = infer_fields(docs, in_batch=True)._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")
    assert nodes == 1


def test_a_build_checks_values_where_it_parses(spark):
    """A build's fields are checked in the batch, not rewritten one by one behind it."""
    docs = shard_docs(lines_df(spark, LINES), "i", "t", shards=2)
    assert "raise_error" not in docs._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(Exception, match="bad field value in document odd"):
        shard_docs(lines_df(spark, [*LINES, "odd\ta:x:integer"]), "i", "t", shards=2).collect()
