"""Write, verify and publish sharded datasets (H1-H4, H7).

Layout under a dataset root::

    <root>/builds/<build_id>/shard_id=<n>/part-….parquet   one build
    <root>/meta/<build_id>_files                            its files: rows, bytes, id range, digest
    <root>/meta/<build_id>_schema                           the columns as they were written
    <root>/meta/<build_id>_runs                             or the builds it is made of (a stream's)
    <root>/CURRENT                                          id of the live build

A build is written next to the live one, verified against what the write has
seen, and only then made live by replacing the small ``CURRENT`` file in one
step.  Verified means content: every stored column of every row is in the digest
(``plans.files``).  Whatever fails before that deletes the new build; the old one stays live.
In ``reject`` mode the documents with bad values are written with the others,
marked in ``_bad``: reading the build leaves them out, ``rejects`` returns them.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shardload.operators.fields import BAD, kept, rejected
from shardload.operators.routing import by_shard, java_order_key, order_shard
from shardload.operators.stats import manifest
from shardload.plans.files import SUMS, digest_sums, scan_files, shard_digests

POINTER = "CURRENT"
SIDE_TABLES = ("", "_manifest", "_doc_values", "_postings", "_numeric_terms", "_field_stats", "_term_stats")
META = ("_files", "_schema", "_runs")
# Writer settings: lookups by id skip row groups that do not hold it.
BLOOM = {"parquet": {"parquet.bloom.filter.enabled#_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"},
         "orc": {"orc.bloom.filter.columns": "_id"}}


def write_sharded(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """H1/H2: one directory per shard; input already placed by ``by_shard``
    and ordered by ``order_shard``, so each task writes one shard file in
    descending id order.  ``errorifexists`` refuses to overwrite."""
    bloom = BLOOM.get(fmt, {}) if "_id" in docs.columns else {}
    docs.write.mode(mode).format(fmt).options(**bloom).partitionBy("shard_id").save(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace ``path`` in one step: readers find the old text or the new one."""
    fs, p, jvm = _fs(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + "." + uuid.uuid4().hex + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.getScheme() == "file":
        os.replace(tmp.toUri().getPath(), p.toUri().getPath())
        checksum = os.path.join(os.path.dirname(path_of := tmp.toUri().getPath()), f".{os.path.basename(path_of)}.crc")
        if os.path.exists(checksum):  # of the temporary name
            os.remove(checksum)
        return
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    p = fs.makeQualified(p)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(tmp), p, options)


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return None if line is None else str(line).strip()
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the input files (paths may be globs)."""
    total = 0
    for path in paths:
        fs, p, _ = _fs(spark, path)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(p) or [])
    return total


def build_path(root: str, build_id: str) -> str:
    return f"{root.rstrip('/')}/builds/{build_id}"


def meta_path(root: str, build_id: str, part: str) -> str:
    return f"{root.rstrip('/')}/meta/{build_id}{part}"


def current_build(spark: SparkSession, root: str) -> str | None:
    return _read_text(spark, f"{root.rstrip('/')}/{POINTER}")


def live_build(spark: SparkSession, root: str) -> str:
    build = current_build(spark, root)
    if build is None:
        raise FileNotFoundError(f"no published build under {root}")
    return build


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def build_runs(spark: SparkSession, root: str, build: str) -> list[str]:
    """The builds whose files make up ``build``: itself, or the runs of a stream's snapshot."""
    text = _read_text(spark, meta_path(root, build, "_runs"))
    return [build] if text is None else json.loads(text)["runs"]


def _load(spark: SparkSession, root: str, build: str, part: str, fmt: str) -> DataFrame:
    """Files or a side table of all runs of a build."""
    runs = [spark.read.format(fmt).load(build_path(root, run) + part) for run in build_runs(spark, root, build)]
    if not runs:
        raise FileNotFoundError(f"build {build} has no documents")
    return reduce(DataFrame.unionByName, runs)


def read_current(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return kept(_load(spark, root, live_build(spark, root), "", fmt))


def verify_publish(expected: DataFrame, written: DataFrame) -> DataFrame:
    """H4: per shard, documents expected (manifest) against documents found
    in the written files; a shard missing on either side fails."""
    found = written.groupBy("shard_id").agg(F.count(F.lit(1)).alias("found"))
    exp = expected.select("shard_id", F.col("n_docs").alias("expected"))
    return (exp.join(found, "shard_id", "full_outer")
            .select("shard_id", F.coalesce("expected", F.lit(0)).alias("expected"),
                    F.coalesce("found", F.lit(0)).alias("found"))
            .withColumn("ok", F.col("expected") == F.col("found")))


def build_manifest(written: DataFrame, build_id: str, shards: int | None = None, files: DataFrame | None = None) -> DataFrame:
    """G3 of a build: ``manifest`` of the kept documents with ``n_rejected``, a row for every shard; with the
    files' table also the digest of each shard's content, and the number of shards that ids are routed by."""
    rows = manifest(kept(written), build_id)
    bad = F.count(F.col(BAD)) if BAD in written.columns else F.lit(0).cast("long")
    rejects = written.groupBy("shard_id").agg(bad.alias("n_rejected"))
    rows = rows.join(rejects, "shard_id", "full_outer")
    if shards is not None:
        rows = rows.join(written.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard_id")),
                         "shard_id", "full_outer")
    if files is not None:
        rows = rows.join(shard_digests(files), "shard_id", "left").withColumn("shards", F.lit(shards).cast("int"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_docs", "n_ids", "n_rejected")}
    return rows.withColumns({"build_id": F.lit(build_id), "generation": F.coalesce("generation", F.lit(1)), **zero})


def write_doc_values(written: DataFrame, path: str, schema: dict[str, str], shards: int, split: int = 1,
                     fmt: str = "parquet") -> None:
    """C4/C5 per shard: ``(_id, _doc)`` and one ``ARRAY<T>`` column per field of ``schema``, derived from the
    written documents (no re-parse), in ranges of the documents' own order."""
    from shardload.operators.docs import doc_values
    dv = doc_values(written, schema, keep=("shard_id", "_id", "_doc"))
    order = (F.col("shard_id"), java_order_key(F.col("_id")).desc(), F.col("_doc"))
    dv.repartitionByRange(shards * max(1, split), *order).sortWithinPartitions(*order) \
        .write.mode("errorifexists").format(fmt).partitionBy("shard_id").save(path)


def write_postings(written: DataFrame, path: str, shards: int, split: int = 1, fmt: str = "parquet",
                   stop_words: tuple[str, ...] | None = None, analyzer: str = "standard") -> None:
    """D1/D2 per shard: the inverted index of every string field, one row per
    (field, term, document), sorted by field, term and id; ``shards * split``
    ranges of them.  ``analyzer`` as in ``operators.postings.ANALYZERS``."""
    from shardload.operators.postings import ENGLISH_STOP_WORDS, analyze_fields, postings
    post = postings(analyze_fields(written, stop_words=ENGLISH_STOP_WORDS if stop_words is None else stop_words,
                                   analyzer=analyzer))
    order = ("shard_id", "field", "term", "_id", "_doc")
    post.repartitionByRange(shards * max(1, split), *order).sortWithinPartitions(*order) \
        .write.mode("errorifexists").format(fmt).partitionBy("shard_id").save(path)


def write_numeric_terms(written: DataFrame, path: str, shards: int, split: int = 1, fmt: str = "parquet") -> None:
    """D4 per shard: every numeric term with its documents, sorted by field and value."""
    from shardload.operators.postings import numeric_postings
    order = ("shard_id", "field", "type", "whole", "real", "_id", "_doc")
    numeric_postings(written).repartitionByRange(shards * max(1, split), *order).sortWithinPartitions(*order) \
        .write.mode("errorifexists").format(fmt).partitionBy("shard_id").save(path)


def write_stats(written: DataFrame, path: str, fmt: str = "parquet") -> None:
    """G1/D3 per shard as mergeable states: fields, and the terms of the index if the build has one (``_postings``)."""
    from shardload.operators.postings import term_stats
    from shardload.operators.stats import field_states
    spark = written.sparkSession
    field_states(written).write.mode("errorifexists").format(fmt).save(path + "_field_stats")
    if exists(spark, path + "_postings"):
        term_stats(spark.read.format(fmt).load(path + "_postings"), by_shard=True) \
            .write.mode("errorifexists").format(fmt).save(path + "_term_stats")


#: Documents of which a task sorts the doc values or postings, at most about.
DOCS_PER_RANGE = 400_000


def side_split(files: DataFrame, shards: int, split: int = 1) -> int:
    """Ranges a shard for the side tables: ``split``, or as many as the documents of the build ask for."""
    rows = files.agg(F.sum("n_rows")).first()[0] or 0
    return max(1, split, -(-rows // (max(1, shards) * DOCS_PER_RANGE)))


def check_doc_values(schema: dict[str, str] | None) -> None:
    from shardload.operators.docs import SLOT_OF_TYPE
    for name, typ in (schema or {}).items():
        if typ not in SLOT_OF_TYPE:
            raise ValueError(f"doc values of {name}: unknown type {typ!r}, known are {', '.join(SLOT_OF_TYPE)}")


def _faulty_shards(docs: DataFrame, files: DataFrame) -> str:
    """Which shards of a failed build differ from its documents, and their files (for the message)."""
    want = docs.groupBy("shard_id").agg(*digest_sums(docs.columns))
    found = files.groupBy("shard_id").agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("digest_xor").alias("digest_xor"),
                                          F.sum("digest_sum").alias("digest_sum"), F.array_sort(F.collect_list("file")).alias("files"))
    both = want.join(found.select("shard_id", "files", *[F.col(c).alias(f"f_{c}") for c in SUMS]), "shard_id", "full_outer")
    bad = both.where(~F.expr(" AND ".join(f"{c} <=> f_{c}" for c in SUMS))).orderBy("shard_id").limit(20).collect()
    return "; ".join(f"shard {r.shard_id}: {', '.join(r.files or ['no files'])}" for r in bad) or "no shard by itself"


def write_build(docs: DataFrame, root: str, build_id: str | None = None, fmt: str = "parquet",
                shards: int | None = None, doc_value_schema: dict[str, str] | None = None,
                with_postings: bool = False, split: int = 1, stop_words: tuple[str, ...] | None = None,
                analyzer: str = "standard", with_stats: bool = False) -> str:
    """H1/H4: write a new build and its side tables and verify it; nothing is made live.

    Rows and a digest of their content are observed while the build is written and
    compared with the files.  Any difference or failure deletes the build and raises.
    Returns the build id."""
    check_doc_values(doc_value_schema)
    spark = docs.sparkSession
    build_id = build_id or uuid.uuid4().hex[:12]
    path = build_path(root, build_id)
    if exists(spark, path):
        raise FileExistsError(f"{path} already exists")
    try:
        observed = Observation("shardload_build")
        write_sharded(docs.observe(observed, *digest_sums(docs.columns)), path, fmt=fmt, mode="errorifexists")
        written = spark.read.schema(docs.schema).format(fmt).load(path)
        _write_text(spark, meta_path(root, build_id, "_schema"), docs.schema.json())
        scan_files(written).write.mode("errorifexists").json(meta_path(root, build_id, "_files"))
        files = read_files(spark, root, build_id)
        found = files.agg(F.sum("n_rows").alias("n_rows"), F.bit_xor("digest_xor").alias("digest_xor"),
                          F.sum("digest_sum").alias("digest_sum")).first().asDict()
        if any((found[k] or 0) != (observed.get.get(k) or 0) for k in SUMS):
            raise IOError(f"build {build_id} failed verification ({observed.get} written, {found} found): {_faulty_shards(docs, files)}")
        build_manifest(written, build_id, shards, files).write.mode("errorifexists").json(path + "_manifest")
        good = kept(written)
        n = shards
        if n is None and (doc_value_schema or with_postings):
            n = int(good.agg(F.max("shard_id")).first()[0] or 0) + 1
        ranges = side_split(files, n, split) if doc_value_schema or with_postings else 1
        if doc_value_schema:
            write_doc_values(good, path + "_doc_values", doc_value_schema, n, ranges, fmt)
        if with_postings:
            write_postings(good, path + "_postings", n, ranges, fmt, stop_words, analyzer)
            write_numeric_terms(good, path + "_numeric_terms", n, ranges, fmt)
        if with_stats:
            write_stats(good, path, fmt)
    except BaseException:
        delete_build(spark, root, build_id)
        raise
    return build_id


def delete_build(spark: SparkSession, root: str, build: str) -> None:
    for suffix in SIDE_TABLES:
        _delete(spark, build_path(root, build) + suffix)
    for suffix in META:
        _delete(spark, meta_path(root, build, suffix))


def set_current(spark: SparkSession, root: str, build: str) -> None:
    _write_text(spark, f"{root.rstrip('/')}/{POINTER}", build)


def publish(docs: DataFrame, root: str, build_id: str | None = None, fmt: str = "parquet",
            shards: int | None = None, doc_value_schema: dict[str, str] | None = None,
            with_postings: bool = False, split: int = 1, stop_words: tuple[str, ...] | None = None,
            analyzer: str = "standard", with_stats: bool = False) -> str:
    """H3: write a new build, verify it (``write_build``), then switch ``CURRENT`` to it.
    On any failure the live build is untouched.  Returns the build id."""
    build_id = write_build(docs, root, build_id, fmt, shards, doc_value_schema, with_postings, split, stop_words, analyzer, with_stats)
    set_current(docs.sparkSession, root, build_id)
    return build_id


def unpublish(spark: SparkSession, root: str) -> None:
    """Drop the live build with its runs (the dataset disappears as a whole)."""
    build = current_build(spark, root)
    runs = build_runs(spark, root, build) if build else []
    _delete(spark, f"{root.rstrip('/')}/{POINTER}")
    for one in {build, *runs} if build else ():
        delete_build(spark, root, one)


def read_files(spark: SparkSession, root: str, build: str) -> DataFrame:
    """The files of a build (one row each), as they were when it was written."""
    from shardload.plans.files import FILES_SCHEMA
    paths = [meta_path(root, run, "_files") for run in build_runs(spark, root, build)]
    return spark.read.schema(FILES_SCHEMA).json(paths)


def read_current_part(spark: SparkSession, root: str, part: str, fmt: str = "parquet") -> DataFrame:
    """A side table of the live build: ``manifest``, ``files``, ``doc_values``, ``postings``, ``numeric_terms``,
    ``field_stats`` and ``term_stats`` (states of the shards), or ``rejects`` of a build in reject mode."""
    build = live_build(spark, root)
    if part == "rejects":
        return rejected(_load(spark, root, build, "", fmt))
    if part == "files":
        return read_files(spark, root, build)
    return _load(spark, root, build, f"_{part}", "json" if part == "manifest" else fmt)


def bulk_action(index: str, doc_type: str) -> F.Column:
    """H7: bulk ``index`` action line of a document."""
    from shardload.operators.docs import json_string
    return F.concat(F.lit('{"index":{"_index":'), json_string(F.lit(index)), F.lit(',"_type":'),
                    json_string(F.lit(doc_type)), F.lit(',"_id":'), json_string(F.col("_id")), F.lit("}}"))


def bulk_lines(docs: DataFrame, index: str, doc_type: str) -> DataFrame:
    """H7: ``(shard_id, _id, bulk)`` where ``bulk`` is the action line and
    the source, newline-separated (the bulk request body of one document)."""
    from shardload.operators.docs import source_json
    return docs.select("shard_id", "_id",
                       F.concat(bulk_action(index, doc_type), F.lit("\n"), source_json("fields")).alias("bulk"))


def write_bulk(docs: DataFrame, path: str, index: str, doc_type: str, shards: int | None = None, split: int = 1) -> None:
    """H7: bulk bodies as text, one directory per shard.  With ``shards`` the
    documents are placed first (they need not be), so a shard's bodies are in
    ``split`` files and in order."""
    if shards is not None:
        docs = order_shard(by_shard(docs, shards, split))
    bulk_lines(docs, index, doc_type).select("shard_id", F.col("bulk").alias("value")) \
        .write.mode("errorifexists").partitionBy("shard_id").text(path)
