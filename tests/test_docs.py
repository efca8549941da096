"""Document assembly: source JSON, meta, field names, doc values, ordering."""

import json

from pyspark.sql import functions as F

from conftest import lines_df
from shardload.operators.docs import (all_text, assemble, doc_values, sort_numeric,
                                      source_json, to_wide)
from shardload.operators.fields import infer_fields, parse_docs
from shardload.sources.lines import keyed_lines

LINES = ["d1\ta:1,a:2,q:\"x\\y\"", "d2\tn:2:integer,n:2:integer,n:-1:integer", "d3\ta:x,a:x,tag",
         "d4\ta.b.c:1:integer,f:NaN:double,g:1e40:float", "d5\tz:-0.0:double"]


def _docs(spark):
    return parse_docs(keyed_lines(lines_df(spark, LINES)), on_error="null")


def test_source_json(spark):
    got = {r["_id"]: r["s"] for r in _docs(spark).select("_id", source_json("fields").alias("s")).collect()}
    assert got["d1"] == '{"a":"1","a":"2","q":"\\"x\\\\y\\""}'
    assert got["d2"] == '{"n":2,"n":2,"n":-1}'
    assert got["d3"] == '{"a":"x","a":"x","col_tag":1}'
    assert got["d4"] == '{"a.b.c":1,"f":"NaN","g":"Infinity"}'
    # duplicate keys: the last one wins for a JSON reader, but all are stored
    assert json.loads(got["d1"])["a"] == "2"


def test_meta_and_field_names(spark):
    out = assemble(_docs(spark), "idx", "t").where(F.col("_id") == "d4").collect()[0]
    assert (out["_index"], out["_type"], out["_uid"], out["_version"]) == ("idx", "t", "t#d4", 1)
    assert out["_field_names"] == ["_source", "_type", "_uid", "_version", "a", "a.b", "a.b.c", "f", "g"]


def test_doc_values(spark):
    dv = {r["_id"]: r for r in doc_values(_docs(spark), {"n": "integer", "a": "string"}).collect()}
    assert dv["d2"]["n"] == [-1, 2, 2]
    assert dv["d1"]["a"] == ["1", "2"]
    assert dv["d3"]["a"] == ["x"]
    assert dv["d1"]["n"] == []


def test_sort_numeric_negative_zero(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-0.0,), (float("nan"),), (float("-inf"),), (None,)], "v double")
    got = [r["v"] for r in sort_numeric(df, "v").collect()]
    assert got[0] == float("-inf")
    assert str(got[1]) == "-0.0" and str(got[2]) == "0.0"
    assert got[3] == 1.0 and got[4] != got[4] and got[5] is None


def test_wide_and_all(spark):
    w = {r["_id"]: r for r in to_wide(_docs(spark), {"n": "integer", "a": "string"}).collect()}
    assert w["d2"]["n"] == 2 and w["d1"]["a"] == "1" and w["d5"]["n"] is None
    arr = {r["_id"]: r["n"] for r in to_wide(_docs(spark), {"n": "integer"}, multi="array").collect()}
    assert arr["d2"] == [2, 2, -1]
    t = {r["_id"]: r["t"] for r in _docs(spark).select("_id", all_text("fields").alias("t")).collect()}
    assert t["d3"] == "x x 1"


def test_infer_fields_conflicts(spark):
    docs = parse_docs(keyed_lines(lines_df(spark, ["a\tx:1:integer", "b\tx:y", "c\tx:2:integer,x:3:integer"])))
    got = {(r["name"], r["type"]): (r["docs"], r["n_values"]) for r in infer_fields(docs).collect()}
    assert got == {("x", "integer"): (2, 3), ("x", "string"): (1, 1)}


def test_json_string_escaping(spark):
    from shardload.operators.docs import json_string
    vals = ["plain", 'q"uote', "back\\slash", "tab\there", "nl\nx", "é日本😀", "", "\u0001", "a/b"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r["j"] for r in df.select(json_string(F.col("v")).alias("j")).collect()]
    assert [json.loads(g) for g in got] == vals
    assert got[0] == '"plain"' and got[8] == '"a/b"'


def test_source_json_dup_policies(spark):
    docs = parse_docs(keyed_lines(lines_df(spark, ["d\ta:1,b:2:integer,a:3,c:x,a:4"])))
    r = docs.select(source_json("fields", "keep").alias("k"), source_json("fields", "last").alias("l"),
                    source_json("fields", "array").alias("a")).collect()[0]
    assert r["k"] == '{"a":"1","b":2,"a":"3","c":"x","a":"4"}'
    assert r["l"] == '{"b":2,"c":"x","a":"4"}'
    assert r["a"] == '{"a":["1","3","4"],"b":2,"c":"x"}'
    assert json.loads(r["a"]) == {"a": ["1", "3", "4"], "b": 2, "c": "x"}


def test_stop_words_keep_positions(spark):
    from shardload.operators.postings import postings, tokenize
    d = spark.createDataFrame([(1, "1", 0, "The cat and THE hat")], "_doc long, _id string, shard_id int, text string")
    stop = spark.createDataFrame([("the",), ("and",)], "term string")
    p = {r["term"]: (r["tf"], r["positions"]) for r in postings(tokenize(d, "text", stop_words=stop)).collect()}
    assert p == {"cat": (1, [1]), "hat": (1, [4])}


def test_wide_predicates_push_down(spark, scratch):
    import os
    from shardload.operators.predicates import fuzzy, range_, term
    path = os.path.join(scratch, "wide")
    spark.createDataFrame([(1.5, 3), (2.5, 7), (9.0, 11)], "price double, size short").write.parquet(path)
    w = spark.read.parquet(path)
    q = w.where(range_("price", "double", 2, 10, include_lo=True, include_hi=False, wide=True)
                & term("size", 7, "short", wide=True))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(price,2.0)" in plan
    assert [r["size"] for r in q.collect()] == [7]
    assert [r["size"] for r in w.where(fuzzy("size", 10, 1, "short", wide=True)).collect()] == [11]


def test_join_of_types_is_a_lattice():
    import itertools

    from shardload.operators.docs import join_types
    types = ("short", "integer", "long", "float", "double", "string")
    for a, b, c in itertools.product(types, repeat=3):
        assert join_types([a]) == a and join_types([a, b]) == join_types([b, a])
        assert join_types([join_types([a, b]), c]) == join_types([a, join_types([b, c])]) == join_types([a, b, c])
    assert join_types(["long", "double"]) == "string" and join_types(["integer", "float"]) == "double"
    assert join_types(["short", "float"]) == "float" and join_types([]) == "string"


def test_wide_without_a_schema(spark):
    import pytest

    from conftest import lines_df
    from shardload.operators.docs import discover_schema, to_wide
    from shardload.plans.build import parsed_docs
    docs = parsed_docs(lines_df(spark, [
        "1\ta:1:short,a:70000:integer,b:9007199254740993:long,tag,_ID:x", "2\ta:5:long,b:0.25:double,A:2.5:float,col_q:w",
        "3\t,,", "4\ta:bad:integer,c:NaN:double,c:1:float"]), on_error="null")
    assert discover_schema(docs) == {"A": "float", "_ID": "string", "a": "long", "b": "string", "c": "double", "col_q": "string"}
    rows = {r[0]: r for r in to_wide(docs).collect()}
    assert to_wide(docs).columns == ["_id", "A", "_ID__2", "a__2", "b", "c", "col_q"]
    assert tuple(rows["1"])[1:] == (None, "x", 1, "9007199254740993", None, None)
    assert tuple(rows["2"])[1:] == (2.5, None, 5, "0.25", None, "w")
    assert tuple(rows["3"])[1:] == (None,) * 6 and rows["4"][3] is None and str(rows["4"][5]) == "nan"
    assert {r[0]: r[3] for r in to_wide(docs, multi="array").collect()} == {"1": [1, 70000], "2": [5], "3": [], "4": []}
    with pytest.raises(ValueError, match="more than 3"):
        to_wide(docs, max_columns=3)
    assert to_wide(docs.where("_id = 'none'")).columns == ["_id"]


def test_repeated_names_against_plain_python(spark):
    """Both policies, document by document; the fields are not sorted by interpreted comparisons."""
    import json
    import random

    rnd, lines = random.Random(4), []
    for k in range(60):
        cells = [f"{rnd.choice(['a', 'b', 'q\"t', 'é', 'a.b'])}:{rnd.choice(['x', 'y\\z', '', '7'])}x" for _ in range(rnd.randrange(12))]
        lines.append(f"{k}\tn:{k}:long,{','.join(cells)},tag{k % 3}")
    docs = parse_docs(keyed_lines(lines_df(spark, lines)), on_error="null")
    docs = docs.unionByName(docs.where("_id = '0'").withColumn("fields", F.lit(None).cast(docs.schema["fields"].dataType)))
    out = docs.select("fields", source_json("fields", "last").alias("l"), source_json("fields", "array").alias("a"))
    assert "array_sort" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = out.collect()
    assert len(rows) == 61
    for r in rows:
        if r["fields"] is None:
            assert r["l"] is None and r["a"] is None
            continue
        last, every = {}, {}
        for f in r["fields"]:
            if f["name"] is not None:
                v = f["str"] if f["type"] == "string" else f["l"] if f["type"] == "long" else f["i"]
                last.pop(f["name"], None)
                last[f["name"]] = v
                every.setdefault(f["name"], []).append(v)
        dump = lambda d: json.dumps(d, ensure_ascii=False, separators=(",", ":"))
        assert r["l"] == dump(last)
        assert r["a"] == dump({n: v[0] if len(v) == 1 else v for n, v in every.items()})


def test_postings_of_documents_shuffle_texts_not_tokens(spark, scratch):
    """The documents are dealt out by their key; grouping their tokens needs no exchange of its own."""
    from shardload.operators.postings import postings, tokenize
    from shardload.sources.tables import documents_docs

    texts = ["b a b", None, "", "A c", "a", "x"]
    rows = [(k, "en", t) for k, t in enumerate(texts)] + [(3, "en", "a d"), (None, "en", "e e")]
    spark.createDataFrame(rows, "doc_id long, lang string, text string").write.parquet(f"{scratch}/documents.parquet")
    p = postings(tokenize(documents_docs(spark, scratch, 5), "text"))
    found = sorted(((r["term"], r["_id"], r["tf"]) for r in p.collect()), key=str)
    assert found == sorted([("a", "0", 1), ("b", "0", 2), ("a", "3", 2), ("c", "3", 1), ("d", "3", 1), ("a", "4", 1),
                            ("x", "5", 1), ("e", None, 2)], key=str)
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
