"""Edge-case lines of the line format (explicit-id mode unless stated)."""

import pytest
from pyspark.sql import functions as F

from conftest import lines_df
from shardload.operators.fields import parse_docs, rejects
from shardload.sources.lines import dropped_lines, keyed_lines, parse_with_schema

EDGE = [
    "u1\tcolor:red", "u2\t7,8", "u3\tage:30:integer,score:1.5:DOUBLE", "u4", "", "u5\t", "u6\t\ta:1",
    "u6b\ta:1\t\tb:2", "u7\t,,", "u7b\ta:1,,b:2", "u8\ta::integer", "u9\tt:12:30:00", "u10\ta:1,a:2",
    "u10b\ta:2:integer,a:2:integer", "u10c\ta:x,a:x", "u11\t:v", "u12\t:", "u13\ta:", "\tx:1",
    "u14\tn: 5:integer", "u14b\tn: 5:double", "u15\ts:40000:short", "u16\td:1e3:double", "u17\tf:1e40:float",
    "u18\tl:9223372036854775807:long", "u18b\tl:9223372036854775808:long", "u19\ta.b.c:1:integer", "\t\t",
    "u20\tx:1", "u20\tx:1",
]


def _val(f):
    for slot in ("i", "l", "s", "f", "d", "str"):
        if f[slot] is not None:
            return f[slot]
    return None


@pytest.fixture(scope="module")
def parsed(spark):
    k = keyed_lines(lines_df(spark, EDGE))
    docs = parse_docs(k, on_error="null").collect()
    by_id = {}
    for r in docs:
        by_id.setdefault(r["_id"], []).append([(f["name"], f["type"], _val(f), f["error"]) for f in r["fields"]])
    return by_id


def test_dropped_lines(parsed):
    for gone in ("u4", "u5"):
        assert gone not in parsed
    assert sum(1 for k in parsed if k == "") == 1          # only "\tx:1"


def test_plain_fields(parsed):
    assert parsed["u1"] == [[("color", "string", "red", None)]]
    assert parsed["u2"] == [[("col_7", "integer", 1, None), ("col_8", "integer", 1, None)]]
    assert parsed["u3"] == [[("age", "integer", 30, None), ("score", "double", 1.5, None)]]


def test_empty_cells(parsed):
    assert parsed["u6"] == [[("a", "string", "1", None)]]
    assert parsed["u6b"] == [[("a", "string", "1", None), ("col_", "integer", 1, None), ("b", "string", "2", None)]]
    assert parsed["u7"] == [[]]
    assert parsed["u7b"] == [[("a", "string", "1", None), ("col_", "integer", 1, None), ("b", "string", "2", None)]]


def test_parts_rules(parsed):
    assert parsed["u9"] == [[("t", "string", "12", None)]]
    assert parsed["u11"] == [[("", "string", "v", None)]]
    assert parsed["u12"] == [[(None, None, None, "malformed")]]
    assert parsed["u13"] == [[("col_a", "integer", 1, None)]]
    assert parsed[""] == [[("x", "string", "1", None)]]
    assert parsed["u19"] == [[("a.b.c", "integer", 1, None)]]


def test_numbers(parsed):
    assert parsed["u8"] == [[("a", "integer", None, "bad_integer")]]
    assert parsed["u14"] == [[("n", "integer", None, "bad_integer")]]
    assert parsed["u14b"] == [[("n", "double", 5.0, None)]]
    assert parsed["u15"] == [[("s", "short", None, "bad_short")]]
    assert parsed["u16"] == [[("d", "double", 1000.0, None)]]
    assert parsed["u17"][0][0][2] == float("inf")
    assert parsed["u18"] == [[("l", "long", 9223372036854775807, None)]]
    assert parsed["u18b"] == [[("l", "long", None, "bad_long")]]


def test_duplicates_kept(parsed):
    assert parsed["u10"] == [[("a", "string", "1", None), ("a", "string", "2", None)]]
    assert len(parsed["u20"]) == 2


def test_error_modes(spark):
    k = keyed_lines(lines_df(spark, ["ok\ta:1:integer", "bad\ta:x:integer,b:2"]))
    assert [r["_id"] for r in parse_docs(k, on_error="reject").collect()] == ["ok"]
    assert sorted(r["_id"] for r in parse_docs(k, on_error="null").collect()) == ["bad", "ok"]
    rj = rejects(k).collect()
    assert [(r["_id"], r["pos"], r["token"], r["reason"]) for r in rj] == [("bad", 0, "a:x:integer", "bad_integer")]
    with pytest.raises(Exception):
        parse_docs(k, on_error="fail").collect()


def test_auto_id_mode(spark):
    k = keyed_lines(lines_df(spark, ["u4", "", "\t\t", "a:1\tb"]), auto_id=True).collect()
    assert len(k) == 3                                  # the delimiter-only line is dropped
    assert all(len(r["_id"]) == 22 for r in k)
    assert len({r["_id"] for r in k}) == 3
    payloads = sorted(r["payload"] for r in k)
    assert payloads == ["", "a:1\tb", "u4"]


def test_auto_id_stable(spark):
    df = lines_df(spark, ["x", "x", "y"])
    a = sorted(r["_id"] for r in keyed_lines(df, auto_id=True).collect())
    b = sorted(r["_id"] for r in keyed_lines(df, auto_id=True).collect())
    assert a == b and len(set(a)) == 3


def test_custom_delimiter(spark):
    k = keyed_lines(lines_df(spark, ["id1|a:1||b:2|", "id2", "|x"]), delim="|").collect()
    assert sorted((r["_id"], r["payload"]) for r in k) == [("", "x"), ("id1", "a:1||b:2")]
    d = dropped_lines(lines_df(spark, ["id1|a", "lonely", "two||"]), delim="|").collect()
    assert sorted(r["value"] for r in d) == ["lonely", "two||"]


def test_multichar_delimiter(spark):
    k = keyed_lines(lines_df(spark, ["id::a:1::b:2::"]), delim="::").collect()
    assert [(r["_id"], r["payload"]) for r in k] == [("id", "a:1::b:2")]


def test_meta_schema(spark):
    k = keyed_lines(lines_df(spark, ["1\tann\t7\t1.5", "2\tbob\tx", "3\tcy"]))
    rows = {r["_id"]: r for r in parse_with_schema(k, "name:string,age:integer,score:double").collect()}
    assert (rows["1"]["name"], rows["1"]["age"], rows["1"]["score"], rows["1"]["_bad"]) == ("ann", 7, 1.5, 0)
    assert rows["2"]["age"] is None and rows["2"]["_bad"] == 1
    assert rows["3"]["score"] is None and rows["3"]["_bad"] == 0


def _jsplit(s, sep):
    """Plain-Python statement of Java's split for a literal separator."""
    if s == "":
        return [""]
    t = s
    while t.endswith(sep):
        t = t[: -len(sep)]
    return [] if t == "" else t.split(sep)


@pytest.mark.parametrize("delim", ["\t", "|", " ", ",", ":", "::"])
def test_columns_match_java_split(spark, delim):
    import random
    from shardload.operators.fields import columns_of
    rnd = random.Random(7)
    alphabet = ["a", ",", delim, ":", "", "b,", ",,", delim * 2]
    rows = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(800)]
    rows += ["", ",", delim, f",{delim},", f"a,{delim},b", f"{delim},,{delim}"]
    df = spark.createDataFrame([(r,) for r in rows], "p string")
    got = df.select("p", columns_of(F.col("p"), delim).alias("c")).collect()
    bad = [(r.p, r.c) for r in got if [c for cell in _jsplit(r.p, delim) for c in _jsplit(cell, ",")] != r.c]
    assert not bad, bad[:5]


def test_coerce_and_split_fields(spark):
    from shardload.operators.fields import coerce, split_fields
    df = spark.createDataFrame([("7",), (" 7",), ("+7",), ("1.5",), ("1e3",), ("x",), ("40000",)], "v string")
    got = df.select(coerce(F.col("v"), "integer").alias("i"), coerce(F.col("v"), "short").alias("s"),
                    coerce(F.col("v"), "double").alias("d")).collect()
    assert [r["i"] for r in got] == [7, None, 7, None, None, None, 40000]
    assert [r["s"] for r in got] == [7, None, 7, None, None, None, None]
    assert [r["d"] for r in got] == [7.0, 7.0, 7.0, 1.5, 1000.0, None, 40000.0]
    rows = split_fields(keyed_lines(lines_df(spark, ["a\tx:1,y\t\tz"]))).collect()
    assert [(r["pos"], r["column"]) for r in rows] == [(0, "x:1"), (1, "y"), (2, ""), (3, "z")]


def test_meta_schema_java_rules(spark):
    k = keyed_lines(lines_df(spark, ["1\t 7\t7"]))
    r = parse_with_schema(k, "a:integer,b:integer").collect()[0]
    assert (r["a"], r["b"], r["_bad"]) == (None, 7, 1)
