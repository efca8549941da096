import duckdb

import corpus_pipeline
from shardload.llm import line_dedup


def by_hand(rows, ratio, least):
    pages, seen = {}, {}
    for host, text in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in text.split("\n")} - {""} if text is not None else ():
            seen[host, line] = seen.get((host, line), 0) + 1
    bad = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" ")) not in bad) for h, t in rows]


def test_against_plain_python(spark):
    rows = [("a", f"menu\nbody {i}\n\n menu \nmenu2") for i in range(10)]
    rows += [(None, f"x{i % 3}\nfoot") for i in range(12)] + [("b", "menu\nrest"), ("b", None), ("c", "")]
    df = spark.createDataFrame([(i, h, t, "v") for i, (h, t) in enumerate(rows)], "doc_id int, source string, text string, h string")
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(df, max_ratio=0.5, min_pages=3, counts=True).collect()}
    want = by_hand(rows, 0.5, 3)
    assert [got[i].text for i in range(len(rows))] == want
    assert got[0].n_lines == 5 and got[0].n_dropped == 3 and got[0].h == "v"
    assert got[23].text is None and got[23].n_lines == 0


def test_edges(edge_docs, no_docs):
    out = line_dedup.drop_boilerplate(edge_docs)
    assert out.columns == edge_docs.columns and sorted(out.collect(), key=str) == sorted(edge_docs.collect(), key=str)
    assert line_dedup.drop_boilerplate(no_docs, counts=True).count() == 0


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "small", lambda df, limit: df)
    rows = [("a", f"menu\nbody {i}") for i in range(10)]
    df = spark.createDataFrame(rows, "source string, text string")
    assert all("menu" not in r.text for r in line_dedup.drop_boilerplate(df).collect())


def test_oracle_on_a_fixture(spark):
    rows = [(i, f"s{i % 2}", f"top {i % 2}\nmid {i}\n\nend") for i in range(40)] + [(40, "s0", None), (41, None, "solo")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    con = duckdb.connect()
    documents = df.toPandas()  # noqa: F841
    con.register("documents", documents)
    want = sorted(con.execute(line_dedup.ORACLE).fetchall())
    got = line_dedup.drop_boilerplate(df, counts=True).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_large_group_of_copies_survives_the_pipeline(spark):
    copy = "first line of the copies\n" + "\n".join(f"their line {k} with words of its own" for k in range(12))
    rows = [(i, "a", copy) for i in range(40)] + [
        (40 + i, "a", "menu\n" + "\n".join(f"page {i} part {k} word{i * 37 + k}" for k in range(8))) for i in range(80)]
    df = spark.createDataFrame([(*r, len(r[2])) for r in rows], "doc_id long, source string, text string, n_chars int")
    clean = corpus_pipeline.line_stage(spark, df, "")
    assert {r.text for r in clean.where("doc_id < 40").collect()} == {copy}
    assert all("menu" not in r.text for r in clean.collect())
    kept = corpus_pipeline.near_duplicate_stage(spark, clean, "").collect()
    assert [r.text for r in kept if r.doc_id < 40] == [copy]


def test_hosts_with_many_boilerplate_lines(spark, monkeypatch):
    """A wide host's lines are looked up in buckets; beyond the bound on lines the hosts are joined, not broadcast."""
    rows = [("wide", "\n".join([*(f"fixed {k}" for k in range(700)), f"own {i}"])) for i in range(8)]
    rows += [("thin", f"menu\nbody {i}") for i in range(8)] + [(None, f"x\n{i}") for i in range(6)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, source string, text string")
    want = by_hand(rows, line_dedup.MAX_RATIO * 3, line_dedup.MIN_PAGES)
    for bound in (line_dedup.BROADCAST_LINES, 100):
        monkeypatch.setattr(line_dedup, "BROADCAST_LINES", bound)
        out = line_dedup.drop_boilerplate(df, max_ratio=line_dedup.MAX_RATIO * 3, counts=True)
        got = {r.doc_id: r for r in out.collect()}
        assert [got[i].text for i in range(len(rows))] == want and got[0].n_dropped == 700
        joins = out._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=broadcast" in joins) == (bound > 100)
