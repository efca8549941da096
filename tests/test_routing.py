"""Routing hash vectors, SQL-oracle agreement and shard placement."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF001, lines_df
from shardload.functions.routing_hash import murmur3_utf16
from shardload.operators.routing import by_shard, order_shard, route, route_hash, shard_skew
from shardload.plans.build import parsed_docs, shard_docs
from shardload.plans.oracle_sql import murmur3_signed
from shardload.sources.tables import orders_lines

# Published murmur3_x86_32 (seed 0) of UTF-16LE strings.
VECTORS = [
    ("hell", 0x5A0CB7C3), ("hello", 0xD7C31989), ("hello w", 0x22AB2984), ("hello wo", 0xDF0CA123),
    ("hello wor", 0xE7744D61), ("The quick brown fox jumps over the lazy dog", 0xE07DB09C),
    ("1", 0xF879CC33), ("123", 0xE1926991), ("testkey", 0x0CE8A214),
]


def _signed(u):
    return u - (1 << 32) if u >= (1 << 31) else u


def _py_murmur(s: str) -> int:
    """Plain-Python reference (independent of the NumPy version)."""
    data = s.encode("utf-16-le", "surrogatepass")
    m = 0xFFFFFFFF
    rotl = lambda x, r: ((x << r) | (x >> (32 - r))) & m
    h = 0
    n = len(data) // 4
    for i in range(n):
        k = int.from_bytes(data[4 * i:4 * i + 4], "little")
        k = (rotl((k * 0xCC9E2D51) & m, 15) * 0x1B873593) & m
        h = (rotl(h ^ k, 13) * 5 + 0xE6546B64) & m
    tail = data[4 * n:]
    if tail:
        k = int.from_bytes(tail, "little")
        k = (rotl((k * 0xCC9E2D51) & m, 15) * 0x1B873593) & m
        h ^= k
    h ^= len(data)
    h ^= h >> 16
    h = (h * 0x85EBCA6B) & m
    h ^= h >> 13
    h = (h * 0xC2B2AE35) & m
    h ^= h >> 16
    return _signed(h)


def test_vectors_numpy():
    got = murmur3_utf16([v for v, _ in VECTORS])
    assert [int(x) for x in got] == [_signed(h) for _, h in VECTORS]


def test_numpy_matches_python_reference():
    ids = ["", "a", "é", "日本語", "emoji😀", "x" * 257, "-1", "a,b:c"] + [str(i) for i in range(500)]
    assert [int(x) for x in murmur3_utf16(ids)] == [_py_murmur(s) for s in ids]


def test_udf_and_sql_oracle(spark):
    ids = [v for v, _ in VECTORS] + ["é-ü", "12345678901"]
    df = spark.createDataFrame([(s,) for s in ids], "_id string")
    spark_h = {r["_id"]: r["hash"] for r in route_hash(df).collect()}
    assert all(spark_h[v] == _signed(h) for v, h in VECTORS)
    con = duckdb.connect()
    duck = dict(con.execute(f"SELECT s, {murmur3_signed('s')} FROM (SELECT unnest($ids) AS s)", {"ids": ids}).fetchall())
    assert {k: int(v) for k, v in duck.items()} == spark_h


def test_shard_is_non_negative_mod(spark):
    df = route(spark.createDataFrame([(v,) for v, _ in VECTORS], "_id string"), 5)
    got = {r["_id"]: r["shard_id"] for r in df.collect()}
    assert got["hello"] == 1 and got["hello w"] == 3 and got["testkey"] == 1 and got["1"] == 3
    assert all(0 <= s < 5 for s in got.values())


def test_placement_partition_is_shard(spark):
    docs = order_shard(by_shard(parsed_docs(orders_lines(spark, SF001), shards=5), 5))
    rows = docs.select("shard_id", "_id", F.spark_partition_id().alias("p")).collect()
    assert all(r["shard_id"] == r["p"] for r in rows)
    by_part = {}
    for r in rows:
        by_part.setdefault(r["p"], []).append(r["_id"])
    for ids in by_part.values():
        assert ids == sorted(ids, reverse=True)


def test_split_ranges_spread_a_hot_id_and_keep_the_order(spark):
    hot = ["hot\tx:%d" % i for i in range(300)] + ["cold%d\tx:1" % i for i in range(60)]
    docs = shard_docs(lines_df(spark, hot), "i", shards=3, split=4)
    rows = docs.select("shard_id", "_id", "_doc", F.spark_partition_id().alias("p")).collect()
    hot_rows = [r for r in rows if r["_id"] == "hot"]
    assert len(rows) == 360 and len({r["p"] for r in hot_rows}) > 1
    for shard in range(3):
        own = [r for r in rows if r["shard_id"] == shard]       # collected partition by partition
        assert [r["p"] for r in own] == sorted(r["p"] for r in own)
        ids = [r["_id"] for r in own]
        assert ids == sorted(ids, reverse=True)
        ties = [r["_doc"] for r in own if r["_id"] == "hot"]
        assert ties == sorted(ties)


def test_one_exchange_of_thin_rows(spark):
    for split in (1, 3):
        docs = shard_docs(lines_df(spark, ["a\tx:1:integer"]), "i", shards=2, split=split)
        plan = docs._jdf.queryExecution().executedPlan().toString()
        above, below = plan.split("Exchange")        # one exchange; documents are assembled above it
        assert "_source" in above and "_source" not in below and "payload" in below


def test_shard_skew(spark):
    s = shard_skew(parsed_docs(orders_lines(spark, SF001), shards=5)).collect()[0]
    assert s["n_shards"] == 5 and s["total_docs"] == 1500 and s["skew"] >= 1.0


def test_auto_split():
    from shardload.operators.routing import auto_split
    assert auto_split(0, 4) == 1 and auto_split(4 << 30, 4, 512 << 20) == 2 and auto_split((4 << 30) + 1, 4, 512 << 20) == 3


def test_udf_runs_without_package_on_worker_path(tmp_path):
    """The driver imports the repo by path; Python workers must not need it."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['q_route'](spark, %r).count())\n" % (root, SF001))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 1500" in out.stdout, out.stderr[-2000:]


def test_shard_order_is_java_order(spark):
    ids = ["�", "\U0001F600", "a", "b\U0001F600", "b￿"]
    df = spark.createDataFrame([(i, 0) for i in ids], "_id string, shard_id int").repartition(1)
    got = [r["_id"] for r in order_shard(df).collect()]
    java_desc = sorted(ids, key=lambda s: s.encode("utf-16-be"), reverse=True)
    assert got == java_desc
    assert got.index("�") < got.index("\U0001F600")     # differs from code-point order


def test_numpy_hash_random_unicode():
    import random
    rnd = random.Random(3)
    pool = [0x41, 0x7A, 0xE9, 0x3B1, 0x4E2D, 0xFFFD, 0x1F600, 0x10348, 0x20000]
    ids = ["".join(chr(rnd.choice(pool)) for _ in range(rnd.randint(0, 40))) for _ in range(2000)]
    assert [int(x) for x in murmur3_utf16(ids)] == [_py_murmur(s) for s in ids]


def _ranges(df):
    """partition -> its rows in order."""
    out = {}
    for p, r in df.rdd.mapPartitionsWithIndex(lambda p, rows: ((p, r) for r in rows)).collect():
        out.setdefault(p, []).append(r)
    return out


def test_ranges_by_bytes(spark):
    """A shard of long lines gets more ranges than one of short lines; rows and order are those of one range a shard."""
    import random

    from shardload.plans.build import placed_lines
    from shardload.sources.lines import keyed_lines
    rnd = random.Random(1)
    ids = [f"k{n}" for n in range(1500)] + ["hot"] * 400 + ["é\U0001F600", "￮"]
    from shardload.operators.predicates import shard_for
    lines = [f"{i}\tx:{'y' * (2000 if shard_for(i, 4) == 2 else rnd.randrange(20))}" for i in ids]
    df = lines_df(spark, lines).repartition(3)
    keyed = keyed_lines(df)
    size = {s: sum(len(x) for x in lines if shard_for(x.split("\t")[0], 4) == s) for s in range(4)}
    target = 50_000
    got = _ranges(placed_lines(keyed, 4, range_bytes=target))
    whole = _ranges(placed_lines(keyed, 4))
    by_shard: dict = {}
    for p in sorted(got):
        assert len({r["shard_id"] for r in got[p]}) == 1
        by_shard.setdefault(got[p][0]["shard_id"], []).append(got[p])
    for s in range(4):
        assert [tuple(r) for part in by_shard[s] for r in part] == [tuple(r) for r in whole[s]]
        n = len(by_shard[s])
        assert abs(n - max(1, size[s] / target)) <= 0.3 * size[s] / target + 1, (s, n, size[s])
        for part in by_shard[s]:
            assert sum(len(r["payload"]) + len(r["_id"]) for r in part) < 1.7 * target
    assert len(by_shard[2]) > 5 * min(len(v) for v in by_shard.values())


def test_one_id_is_cut_by_the_document_key(spark):
    from shardload.plans.build import placed_lines
    from shardload.sources.lines import keyed_lines
    keyed = keyed_lines(lines_df(spark, [f"same\tx:{'z' * 500}{k}" for k in range(600)] + ["other\tq:1"]))
    got = _ranges(placed_lines(keyed, 3, range_bytes=30_000))
    parts = [got[p] for p in sorted(got) if got[p][0]["_id"] == "same"]
    assert len(parts) >= 7 and max(map(len, parts)) < 120
    docs = [r["_doc"] for part in parts for r in part if r["_id"] == "same"]
    assert docs == sorted(docs) and len(docs) == 600
    assert sum(map(len, _ranges(placed_lines(keyed.where("_id = 'none'"), 3, range_bytes=1000)).values())) == 0
