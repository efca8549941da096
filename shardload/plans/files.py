"""The files of a build as a table: content digests (H4) and lookups by id.

One row a file: its rows, bytes, range of ids and an order-free digest of the
rows' content.  The digests form a tree: those of a shard's files add up to the
shard's (kept in the manifest), however the shard is cut into files, and the
shards' to the build's, so a check goes down only where something differs.

``verify_build`` compares a build with its table: first names and sizes, which
reads no file, then the content.  ``documents_by_id`` opens the files whose shard
and range an id fits; inside these the id's Bloom filter and the row groups'
ranges skip the rest.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardload.functions.routing_hash import shard_of
from shardload.operators.fields import kept
from shardload.operators.predicates import shard_for

SUMS = ("n_rows", "digest_xor", "digest_sum")
FILES_SCHEMA = ("run string, file string, shard_id int, bytes long, n_rows long, digest_xor long, digest_sum long, "
                "min_id string, max_id string")
#: Ids that are pushed down as a list; more are joined.
LISTED = 1000


def row_digest(columns: list[str]) -> Column:
    """64-bit hash of all columns of a row; a null is told from an absent value beside it."""
    return F.xxhash64(*[x for c in sorted(columns) for x in (F.col(c), F.isnull(c))])


def digest_sums(columns: list[str]) -> list[Column]:
    """Rows, and two order-free sums of the row digests: an exclusive or, and 24 bits of each added up (which sees
    pairs of equal changes; no overflow below 2^39 rows)."""
    return _sums_of(row_digest(columns))


def _sums_of(h: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("digest_xor"),
            F.sum(F.shiftrightunsigned(h, 40)).alias("digest_sum")]


def scan_files(written: DataFrame) -> DataFrame:
    """``FILES_SCHEMA`` of the files that ``written`` reads: one pass, one small row a file."""
    parts = F.split("_metadata.file_path", "/")
    at = lambda k: F.element_at(parts, -k)
    # Texts' least and greatest are taken by sorting, so only what is summed goes there, not whole documents.
    return (written.select(at(3).alias("_run"), F.concat_ws("/", at(2), at(1)).alias("_file"), F.col("_metadata.file_size").alias("_bytes"),
                           "shard_id", "_id", row_digest(written.columns).alias("_digest"))
            .groupBy(F.col("_run").alias("run"), F.col("_file").alias("file"), "shard_id", F.col("_bytes").alias("bytes"))
            .agg(*_sums_of(F.col("_digest")), F.min("_id").alias("min_id"), F.max("_id").alias("max_id"))
            .select(*[c.split()[0] for c in FILES_SCHEMA.split(", ")]))


def _node(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws(":", *parts), 256)


def shard_digests(files: DataFrame) -> DataFrame:
    """``(shard_id, digest)``, the same however the rows of a shard are cut into files."""
    sums = files.groupBy("shard_id").agg(F.sum("n_rows").alias("n"), F.bit_xor("digest_xor").alias("x"), F.sum("digest_sum").alias("s"))
    return sums.select("shard_id", _node(*[F.col(c).cast("string") for c in ("n", "x", "s")]).alias("digest"))


def build_digest(shards: DataFrame) -> str:
    """The digest of a build from ``(shard_id, digest)`` rows, one a shard."""
    one = F.array_sort(F.collect_list(F.struct("shard_id", "digest")))  # as many as shards
    return shards.where("digest IS NOT NULL").agg(one.alias("d")).select(
        _node(F.array_join(F.transform("d", lambda x: F.concat_ws("=", x["shard_id"].cast("string"), x["digest"])), ","))).first()[0]


def _there(spark: SparkSession, paths: list[str], fmt: str) -> DataFrame:
    """``(run, file, found)``: names and sizes of the data files in the folders, unread."""
    parts = F.split("path", "/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{fmt}").load(paths)
    return found.select(F.element_at(parts, -3).alias("run"), F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("file"),
                        F.col("length").alias("found"))


def verify_build(spark: SparkSession, root: str, build: str | None = None, fmt: str = "parquet", content: bool = True,
                 sizes: bool = True) -> DataFrame:
    """H4: ``(run, shard_id, file, fault)`` of every file that is not as it was written: ``missing``, ``unexpected``,
    ``size`` or ``content``.  Files of a wrong size are not read."""
    from shardload.plans.publish import build_path, build_runs, live_build, read_files
    build = build or live_build(spark, root)
    runs = build_runs(spark, root, build)
    paths = [build_path(root, run) for run in runs]
    expected = read_files(spark, root, build)
    key = ["run", "file"]
    both = expected.select(*key, "shard_id", "bytes").join(_there(spark, paths, fmt), key, "full_outer")
    shard = F.coalesce("shard_id", F.regexp_extract("file", "shard_id=([0-9]+)", 1).try_cast("int"))
    fault = (F.when(F.col("found").isNull(), "missing").when(F.col("bytes").isNull(), "unexpected")
             .when(F.lit(sizes) & (F.col("bytes") != F.col("found")), "size"))
    listed = both.select("run", shard.alias("shard_id"), "file", fault.alias("fault"))
    if not content:
        return listed.where("fault IS NOT NULL")
    bad = listed.where("fault IS NOT NULL").select(*key).collect()  # the faulty files alone
    wrong = {(r.run, r.file) for r in bad}
    stored = [r for r in expected.select(*key, "shard_id").collect() if (r.run, r.file) not in wrong]  # a name for each file
    if not stored:
        return listed.where("fault IS NOT NULL")
    seen = None
    for run, path in zip(runs, paths):
        files = [f"{path}/{r.file}" for r in stored if r.run == run]
        if files:
            one = scan_files(spark.read.schema(_schema_of(spark, root, run)).format(fmt).option("basePath", path).load(files))
            seen = one if seen is None else seen.unionByName(one)
    found = seen.select(*key, *[F.col(c).alias(f"f_{c}") for c in SUMS])
    differs = ~F.expr(" AND ".join(f"{c} <=> f_{c}" for c in SUMS))
    changed = expected.join(found, key).where(differs).select("run", "shard_id", "file", F.lit("content").alias("fault"))
    return listed.where("fault IS NOT NULL").unionByName(changed)


def _schema_of(spark: SparkSession, root: str, run: str):
    """The columns as they were written (text formats would be read back with other types)."""
    from shardload.plans.publish import _read_text, meta_path
    return StructType.fromJson(json.loads(_read_text(spark, meta_path(root, run, "_schema"))))


def open_files(spark: SparkSession, root: str, hits: list, fmt: str) -> DataFrame:
    """The documents in some files of a build, named by rows ``(run, file)``; columns as ``read_current`` has them."""
    from shardload.plans.publish import build_path
    by_run: dict[str, list[str]] = {}
    for r in hits:
        by_run.setdefault(r.run, []).append(f"{build_path(root, r.run)}/{r.file}")
    parts = [spark.read.schema(_schema_of(spark, root, run)).format(fmt).option("basePath", build_path(root, run)).load(sorted(paths))
             for run, paths in sorted(by_run.items())]
    docs = kept(reduce(DataFrame.unionByName, parts))
    return docs.select(*[c for c in docs.columns if c != "shard_id"], "shard_id")


def shard_faults(spark: SparkSession, root: str, build: str | None = None, fmt: str = "parquet") -> DataFrame:
    """H4, the upper levels of the tree: ``(shard_id, expected, found)`` of the shards whose files no longer add up to the
    digest in the manifest."""
    from shardload.plans.publish import build_path, build_runs, live_build
    build = build or live_build(spark, root)
    faults = None
    for run in build_runs(spark, root, build):
        path = build_path(root, run)
        want = spark.read.json(path + "_manifest").select(F.col("shard_id").cast("int").alias("shard_id"), F.col("digest").alias("expected"))
        found = shard_digests(scan_files(spark.read.schema(_schema_of(spark, root, run)).format(fmt).load(path)))
        one = want.join(found.withColumnRenamed("digest", "found"), "shard_id", "full_outer").where("NOT expected <=> found")
        faults = one if faults is None else faults.unionByName(one)
    return faults


class _Ranges:
    """Which files can hold an id: of each shard the ranges by their least id, and the greatest id up to each."""

    def __init__(self, files: list):
        self.shards: dict[int, tuple[list, list, list]] = {}
        for k, r in sorted(enumerate(files), key=lambda x: (x[1]["shard_id"], x[1]["min_id"].encode("utf-8", "surrogatepass"))):
            low, high, which = self.shards.setdefault(r["shard_id"], ([], [], []))
            greatest = r["max_id"].encode("utf-8", "surrogatepass")
            low.append(r["min_id"].encode("utf-8", "surrogatepass"))
            high.append((greatest, max(greatest, high[-1][1]) if high else greatest))
            which.append(k)

    def holding(self, shard: int, doc_id: str) -> list[int]:
        low, high, which = self.shards.get(shard, ((), (), ()))
        key = doc_id.encode("utf-8", "surrogatepass")
        at, found = bisect_right(low, key) - 1, []
        while at >= 0 and high[at][1] >= key:
            if high[at][0] >= key:
                found.append(which[at])
            at -= 1
        return found


def files_holding(files: DataFrame, asked: DataFrame | list[tuple[int, str]]) -> list:
    """Rows ``(run, file)`` of the files that can hold one of the asked ``(shard_id, _id)``.  The driver holds the
    files' ranges (a row each); a table of ids is looked up in tasks, by bisection, and only file numbers come back."""
    rows = files.where("min_id IS NOT NULL").select("run", "file", "shard_id", "min_id", "max_id").collect()
    ranges = _Ranges(rows)
    if isinstance(asked, list):
        return [rows[k] for k in sorted({k for shard, i in asked for k in ranges.holding(shard, i)})]

    def look_up(shard: pd.Series, doc_id: pd.Series) -> pd.Series:
        return pd.Series([ranges.holding(s, i) for s, i in zip(shard, doc_id)], dtype=object)

    hit = F.explode(F.pandas_udf(look_up, "array<int>")("shard_id", "_id")).alias("k")
    return [rows[r.k] for r in sorted(asked.select(hit).distinct().collect())]


def documents_by_id(spark: SparkSession, root: str, ids: list[str] | DataFrame, shards: int | None = None,
                    fmt: str = "parquet") -> DataFrame:
    """The documents of the live build with these ids (a list, or a column ``_id``).

    The files' table says which files can hold one: the shard that the id is routed to, and a range around it.  Only
    these are opened.  ``shards`` is needed only for a build published without it."""
    from shardload.plans.publish import read_current, read_current_part
    listed = None
    if not isinstance(ids, DataFrame):
        listed = sorted({i for i in ids if i is not None})
    if shards is None:
        said = read_current_part(spark, root, "manifest", fmt)  # JSON has no column that is null in every row
        shards = said.agg(F.max("shards")).first()[0] if "shards" in said.columns else None
        if shards is None:
            raise ValueError("the build does not say by how many shards ids were routed")
    files = read_current_part(spark, root, "files", fmt)
    if listed is None:
        ids = ids.select("_id").where("_id IS NOT NULL").distinct()
        hits = files_holding(files, ids.withColumn("shard_id", shard_of("_id", int(shards))))
    else:
        hits = files_holding(files, [(shard_for(i, int(shards)), i) for i in listed])
        if len(listed) > LISTED:
            ids = spark.createDataFrame([(i,) for i in listed], "_id string")
    if not hits:
        return read_current(spark, root, fmt).where(F.lit(False))
    found = open_files(spark, root, hits, fmt)
    if listed is not None and len(listed) <= LISTED:
        return found.where(F.col("_id") == listed[0] if len(listed) == 1 else F.col("_id").isin(listed))
    return found.join(ids.select("_id"), "_id", "left_semi").select(found.columns)

