"""Lookups that open one file, content digests that name the file, and posting intersection."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from shardload.operators.predicates import shard_for
from shardload.plans import files as files_module
from shardload.plans import search as search_module
from shardload.plans.build import shard_docs
from shardload.plans.files import build_digest, documents_by_id, shard_digests, shard_faults, verify_build
from shardload.plans.publish import build_path, current_build, publish, read_current, read_current_part, write_build
from shardload.plans.search import Range, Term, around, equals, search, words
from shardload.sources.tables import orders_lines


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("built") / "ds")
    publish(shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5, split=3), root, build_id="b", shards=5, split=3,
            with_postings=True, doc_value_schema={"total": "double"})
    return root


def scanned_rows(df) -> int:
    """Rows that the file scans of a collected frame gave out."""
    def leaves(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return leaves(node.executedPlan())
        kids = node.children()
        if kids.size() == 0:
            return [node]
        return [x for i in range(kids.size()) for x in leaves(kids.apply(i))]
    return sum(n.metrics().apply("numOutputRows").value() for n in leaves(df._jdf.queryExecution().executedPlan())
               if n.nodeName().startswith("Scan parquet"))


def data_files(root, build="b"):
    path = build_path(root, build)
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_one_id_opens_one_file(spark, built):
    assert len(data_files(built)) >= 12
    got = documents_by_id(spark, built, ["42"])
    assert len(got.inputFiles()) == 1
    rows = got.collect()
    assert [(r["_id"], r["shard_id"]) for r in rows] == [("42", shard_for("42", 5))]
    assert rows[0].asDict() == read_current(spark, built).where("_id = '42'").first().asDict()


def test_bloom_filter_skips_the_row_groups(spark, built):
    ids = {r["_id"] for r in read_current(spark, built).select("_id").collect()}
    absent = [f"{i}x" for i in range(100, 400) if f"{i}x" not in ids][:40]
    opened = read_rows = 0
    for i in absent:
        q = documents_by_id(spark, built, [i])
        opened += bool(q.inputFiles())
        assert q.collect() == []
        read_rows += scanned_rows(q) if q.inputFiles() else 0
    assert opened > 20 and read_rows < 0.2 * opened * 100  # files hold about 100 rows; ranges alone would read them


def test_ids_as_a_list_or_a_table(spark, built, monkeypatch):
    every = [r["_id"] for r in read_current(spark, built).select("_id").collect()]
    assert sorted(r["_id"] for r in documents_by_id(spark, built, every + every[:3] + ["no", None]).collect()) == sorted(every)
    monkeypatch.setattr(files_module, "LISTED", 2)
    assert documents_by_id(spark, built, every[:7] + ["no"]).count() == 7
    ids = spark.createDataFrame([(x, 1) for x in (every[0], every[0], every[5], "no", None)], "_id string, shard_id int")
    assert sorted(r["_id"] for r in documents_by_id(spark, built, ids).collect()) == sorted([every[0], every[5]])
    assert documents_by_id(spark, built, []).count() == 0
    assert documents_by_id(spark, built, ["no"]).columns == read_current(spark, built).columns


def test_repeated_ids_and_rejects(spark, scratch):
    root = os.path.join(scratch, "dup")
    lines = [f"same\tx:{k}:integer" for k in range(30)] + ["same\tx:bad:integer", "other\ty:1:integer"]
    publish(shard_docs(lines_df(spark, lines), "i", shards=3, split=2, on_error="reject"), root, shards=3, split=2)
    assert documents_by_id(spark, root, ["same"]).count() == 30
    other = os.path.join(scratch, "unknown")
    publish(shard_docs(lines_df(spark, lines[:2]), "i", shards=3), other)
    with pytest.raises(ValueError, match="routed"):
        documents_by_id(spark, other, ["same"])
    assert documents_by_id(spark, other, ["same"], shards=3).count() == 2


def rewrite(path, column, row, value):
    """Change one stored value in place."""
    t = pq.read_table(path, partitioning=None)
    i = t.schema.get_field_index(column)
    values = t.column(i).to_pylist()
    values[row] = value(values[row])
    pq.write_table(t.set_column(i, t.schema.field(i), pa.array(values, t.schema.field(i).type)), path)


def test_a_changed_value_names_its_file(spark, scratch):
    root = os.path.join(scratch, "ds")
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5, split=2)
    publish(docs, root, build_id="b", shards=5, split=2)
    assert verify_build(spark, root).count() == 0 and shard_faults(spark, root).count() == 0
    path = data_files(root)[3]
    os.remove(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"))
    rewrite(path, "_source", 5, lambda s: s.replace("cust", "cusT"))
    name = "/".join(path.split("/")[-2:])
    shard = int(name.split("/")[0].split("=")[1])
    got = verify_build(spark, root, sizes=False).collect()
    assert [(r.run, r.shard_id, r.file, r.fault) for r in got] == [("b", shard, name, "content")]
    assert [r.shard_id for r in shard_faults(spark, root).collect()] == [shard]
    # sizes alone need no read: a cut file, a file too many and one too few
    files = data_files(root)
    with open(files[0], "r+b") as f:
        f.truncate(os.path.getsize(files[0]) - 10)
    os.rename(files[1], files[1].replace("part-", "part-9"))
    got = {(r.file, r.fault) for r in verify_build(spark, root, content=False).where("fault <> 'size' OR file <> '" + name + "'").collect()}
    short = lambda p: "/".join(p.split("/")[-2:])
    assert got == {(short(files[0]), "size"), (short(files[1]), "missing"), (short(files[1]).replace("part-", "part-9"), "unexpected")}
    assert verify_build(spark, root).count() == 4  # the faulty ones are not read, the changed one is found


def test_publish_refuses_changed_content(spark, scratch, monkeypatch):
    """A value that changes between the write and the check fails the publish and names shard and file."""
    from shardload.plans import publish as P
    root = os.path.join(scratch, "ds")
    docs = shard_docs(orders_lines(spark, SF001), "orders", "order", shards=5)
    publish(docs, root, build_id="good", shards=5)
    write = P.write_sharded

    def corrupt(frame, path, **kw):
        write(frame, path, **kw)
        name = data_files(root, "bad")[2]
        os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
        rewrite(name, "_source", 0, lambda s: s + " ")
    monkeypatch.setattr(P, "write_sharded", corrupt)
    with pytest.raises(IOError, match=r"shard 2: shard_id=2/part-"):
        publish(docs, root, build_id="bad", shards=5)
    assert current_build(spark, root) == "good" and not [f for f in os.listdir(os.path.join(root, "builds")) if f.startswith("bad")]


def test_digests_do_not_depend_on_the_cut(spark, scratch):
    lines = orders_lines(spark, SF001).select("value", "_doc")
    digests = []
    for split in (1, 3):
        root = os.path.join(scratch, f"s{split}")
        publish(shard_docs(lines, "orders", "order", shards=4, split=split), root, shards=4, split=split)
        files = read_current_part(spark, root, "files")
        digests.append(({r.shard_id: r.digest for r in shard_digests(files).collect()}, build_digest(shard_digests(files))))
        manifest = {r.shard_id: r.digest for r in read_current_part(spark, root, "manifest").collect()}
        assert manifest == digests[-1][0]
    assert digests[0] == digests[1]


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_formats_verify(spark, scratch, fmt):
    root = os.path.join(scratch, fmt)
    lines = ["a\tx:1:integer,f:0.1:float,d:NaN:double,s:é\"q", "b\tl:9007199254740993:long", "c\t,,"]
    write_build(shard_docs(lines_df(spark, lines), "i", shards=2), root, "b", fmt=fmt, shards=2)
    assert verify_build(spark, root, "b", fmt=fmt).count() == 0


def test_stored_doc_values_tell_documents_apart(spark, built, scratch):
    dv = read_current_part(spark, built, "doc_values")
    docs = read_current(spark, built)
    assert dv.join(docs, ["_doc", "_id", "shard_id"]).count() == docs.count() == dv.select("_doc").distinct().count()
    for d, _, names in os.walk(build_path(built, "b") + "_doc_values"):
        for name in (n for n in sorted(names) if n.endswith(".parquet")):
            ids = pq.read_table(os.path.join(d, name), columns=["_id"], partitioning=None).column(0).to_pylist()
            assert ids == sorted(ids, reverse=True)


def brute(docs, clauses):
    """Documents that match, by a plain look at every one."""
    from shardload.operators.predicates import range_
    def test(c):
        if isinstance(c, Term):  # these fields hold one word each
            return F.exists("fields", lambda x: (x["name"] == c.field) & F.coalesce(F.lower(x["str"]) == c.term, F.lit(False)))
        return range_(c.field, c.type, c.lo, c.hi, c.include_lo, c.include_hi)
    q = docs
    for c in clauses:
        q = q.where(test(c))
    return sorted(r["_id"] for r in q.select("_id").collect())


@pytest.mark.parametrize("limit", [500_000, 3])
def test_search_against_a_plain_look(spark, built, monkeypatch, limit):
    monkeypatch.setattr(search_module, "BROADCAST", limit)  # 3: the joins of large runs
    docs = read_current(spark, built)
    for clauses in ([Term("status", "o")], [Term("status", "f"), Range("total", "double", 1000.0, 250000.0)],
                    [Range("cust", "long", 10, 20), Term("status", "o"), Range("day", "integer", None, 9900, include_hi=False)],
                    [Range("total", "double", 100000.0, include_lo=False), Range("cust", "long", hi=75)],
                    [Term("status", "nowhere"), Term("status", "o")], [Range("cust", "long", 5, 4)]):
        got = search(spark, built, *clauses)
        assert sorted(r["_id"] for r in got.collect()) == brute(docs, clauses)
        assert got.columns == docs.columns


def test_unmatched_shards_are_not_opened(spark, built):
    one = read_current(spark, built).where("_id = '42'").select(F.explode("fields").alias("f")).where("f.name = 'total'").first().f.d
    got = search(spark, built, equals("total", one, "double"), Term("status", "o"), Term("status", "f"))
    opened = lambda df: [f for f in df.inputFiles() if "/builds/" in f]
    assert opened(got) == []
    status = read_current(spark, built).where("_id = '42'").select(F.explode("fields").alias("f")).where("f.name = 'status'").first().f.str
    got = search(spark, built, equals("total", one, "double"), Term("status", status.lower()))
    assert [r["_id"] for r in got.collect()] == ["42"] and len(opened(got)) == 1


def test_runs_are_pushed_down(spark, built):
    tables = {p: read_current_part(spark, built, p) for p in ("postings", "numeric_terms")}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = search_module._run(tables, Term("status", "o"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(field,status)" in plan and "EqualTo(term,o)" in plan
    plan = search_module._run(tables, Range("cust", "long", 3, 9))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(whole,3)" in plan and "LessThanOrEqual(whole,9)" in plan


def test_numbers_at_the_edges(spark, scratch):
    root = os.path.join(scratch, "n")
    lines = ["a\tv:NaN:double,w:0.1:float", "b\tv:Infinity:double,w:0.3:float", "c\tv:-0.0:double,w:0.2:float", "d\tv:0.0:double,v:7:double",
             "e\tv:7:integer", "f\tt:The quick Quick fox"]
    publish(shard_docs(lines_df(spark, lines), "i", shards=2), root, shards=2, with_postings=True)
    ids = lambda *c: sorted(r["_id"] for r in search(spark, root, *c).collect())
    assert ids(Range("v", "double")) == ["b", "c", "d"] and ids(Range("v", "double", 1.0)) == ["b", "d"]
    assert ids(equals("v", 0.0, "double")) == ["c", "d"] and ids(equals("v", 7, "integer")) == ["e"]
    assert ids(equals("w", 0.1, "float")) == ["a"] and ids(around("w", 0.2, 0.1, "float")) == ["a", "b", "c"]
    assert ids(*words(spark, "t", "QUICK, fox!")) == ["f"] and ids(Term("t", "quick"), Range("v", "double")) == []
    with pytest.raises(ValueError):
        search(spark, root)


def test_ranges_hold_every_id():
    """Overlapping and nested ranges, in the order of the stored minima and maxima (UTF-8 bytes)."""
    import random
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("ab￮\U0001F600é") for _ in range(rnd.randrange(1, 4)))
    key = lambda s: s.encode()
    files = [dict(zip(("shard_id", "min_id", "max_id"), (rnd.randrange(3), *sorted((word(), word()), key=key)))) for _ in range(60)]
    ranges = files_module._Ranges(files)
    for _ in range(500):
        s, i = rnd.randrange(4), word()
        want = [k for k, f in enumerate(files) if f["shard_id"] == s and key(f["min_id"]) <= key(i) <= key(f["max_id"])]
        assert sorted(ranges.holding(s, i)) == want
