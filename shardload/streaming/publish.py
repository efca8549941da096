"""A stream that ends in a published dataset.

Every micro-batch becomes a run: a verified build of its own, sorted by id in its
shards, with manifest, file digests and (if asked for) doc values and index.  The live
dataset is a snapshot: a small file that lists its runs and the epochs they came from.
Switching ``CURRENT`` to the next snapshot is the only commit, so data and ledger change
in one step or not at all.

* A replayed epoch finds itself in the ledger and changes nothing; if its lines are
  not those of the first time, it is refused.
* Runs of like size (the same power of ``merge_at``) are merged when there are
  ``merge_at`` of them: placed by shard, put in id order and written as one run whose
  content digests must equal the sum of the old ones.  A document is rewritten a
  logarithmic number of times.
* A batch that fails before the switch leaves folders that nothing refers to;
  ``vacuum`` deletes these and merged runs once no reader needs them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardload import DEFAULT_DELIM, DEFAULT_SHARDS, DEFAULT_TYPE
from shardload.operators.routing import by_bytes, by_shard, order_shard
from shardload.plans import publish as P
from shardload.plans.build import shard_docs
from shardload.plans.files import SUMS, _schema_of
from shardload.sources.lines import with_doc_key
from shardload.streaming.ingest import stream_lines

#: Epochs that the ledger remembers; Spark replays only the last one.
REMEMBERED = 1000
#: Bytes of documents that a task of a merge sorts, and of a document for each byte of its source (fields, names).
MERGE_BYTES, ROW_PER_SOURCE = 256 << 20, 8


def snapshot(spark: SparkSession, root: str) -> dict:
    """``{"runs": […], "rows": {run: rows}, "epochs": {epoch: digest of its lines}, "last": epoch}`` of the live dataset.
    A build that was not made by a stream is a single run."""
    build = P.current_build(spark, root)
    if build is None:
        return {"runs": [], "rows": {}, "epochs": {}, "last": -1}
    text = P._read_text(spark, P.meta_path(root, build, "_runs"))
    if text is not None:
        return json.loads(text)
    rows = P.read_files(spark, root, build).agg(F.sum("n_rows")).first()[0] or 0
    return {"runs": [build], "rows": {build: rows}, "epochs": {}, "last": -1}


def _commit(spark: SparkSession, root: str, state: dict) -> str:
    build = f"s-{uuid.uuid4().hex[:12]}"
    P._write_text(spark, P.meta_path(root, build, "_runs"), json.dumps(state))
    P.set_current(spark, root, build)
    return build


def _lines_digest(lines: DataFrame) -> str:
    h = F.xxhash64("value")
    return ":".join(str(x) for x in lines.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(h), F.lit(0)),
                                              F.coalesce(F.sum(F.shiftrightunsigned(h, 40)), F.lit(0))).first())


def _tier(rows: int, merge_at: int) -> int:
    tier = 0
    while rows >= merge_at:
        rows //= merge_at
        tier += 1
    return tier


def _sums(spark: SparkSession, root: str, runs: list[str]) -> tuple:
    files = [P.read_files(spark, root, r) for r in runs]
    one = files[0]
    for f in files[1:]:
        one = one.unionByName(f)
    return tuple(one.agg(F.sum(SUMS[0]), F.bit_xor(SUMS[1]), F.sum(SUMS[2])).first())


def merge_runs(spark: SparkSession, root: str, runs: list[str], shards: int, split: int = 1, fmt: str = "parquet", **side) -> str:
    """One run with the documents of several, rejected ones included, in shard and id order.  The digests must add up."""
    docs = None
    for run in runs:
        one = spark.read.schema(_schema_of(spark, root, run)).format(fmt).load(P.build_path(root, run))
        docs = one if docs is None else docs.unionByName(one)
    placed = by_shard(docs, shards, split) if split > 1 else by_bytes(
        docs, shards, F.coalesce(F.octet_length("_source"), F.lit(0)) * ROW_PER_SOURCE, MERGE_BYTES)
    merged = P.write_build(order_shard(placed), root, f"m-{uuid.uuid4().hex[:12]}", fmt, shards, split=split, **side)
    if _sums(spark, root, [merged]) != _sums(spark, root, runs):
        P.delete_build(spark, root, merged)
        raise IOError(f"merging {', '.join(runs)} changed their content")
    return merged


def apply_batch(lines: DataFrame, root: str, epoch: int, index: str, doc_type: str = DEFAULT_TYPE, delim: str = DEFAULT_DELIM,
                auto_id: bool = False, shards: int = DEFAULT_SHARDS, split: int = 1, on_error: str = "fail", merge_at: int = 4,
                fmt: str = "parquet", **side) -> bool:
    """Add the lines of one epoch to the live dataset; False if they are in it already.

    ``side``: ``doc_value_schema``, ``with_postings`` and ``stop_words`` of the runs, as in ``publish``."""
    if merge_at < 2:
        raise ValueError("merge_at must be 2 or more")
    spark, state = lines.sparkSession, snapshot(lines.sparkSession, root)
    digest = _lines_digest(lines)
    if str(epoch) in state["epochs"]:
        if state["epochs"][str(epoch)] != digest:
            raise ValueError(f"epoch {epoch} came again with other lines than before")
        return False
    if epoch <= state["last"]:
        raise ValueError(f"epoch {epoch} is older than the ledger goes back")
    if not digest.startswith("0:"):
        keyed = with_doc_key(lines).withColumn("_doc", F.concat(F.lit(f"{epoch}-"), F.col("_doc").cast("string")))
        docs = shard_docs(keyed, index, doc_type, delim=delim, auto_id=auto_id, on_error=on_error, shards=shards, split=split)
        run = P.write_build(docs, root, f"e{epoch}-{uuid.uuid4().hex[:8]}", fmt, shards, split=split, **side)
        rows = P.read_files(spark, root, run).agg(F.sum("n_rows")).first()[0] or 0
        if rows:
            state["runs"].append(run)
            state["rows"][run] = rows
        else:
            P.delete_build(spark, root, run)
    while True:
        tiers: dict[int, list[str]] = {}
        for run in state["runs"]:
            tiers.setdefault(_tier(state["rows"][run], merge_at), []).append(run)
        full = next((sorted(t) for _, t in sorted(tiers.items()) if len(t) >= merge_at), None)
        if full is None:
            break
        one = merge_runs(spark, root, full, shards, split, fmt, **side)
        state["runs"] = [r for r in state["runs"] if r not in full] + [one]
        state["rows"][one] = sum(state["rows"].pop(r) for r in full)
    state["epochs"][str(epoch)], state["last"] = digest, epoch
    for old in sorted(state["epochs"], key=int)[:-REMEMBERED]:
        del state["epochs"][old]
    _commit(spark, root, state)
    return True


def publish_stream(spark: SparkSession, src_dir: str, root: str, checkpoint: str, index: str, max_files_per_trigger: int | None = None,
                   available_now: bool = True, processing_time: str | None = None, **build) -> StreamingQuery:
    """Start a stream of text files whose every batch goes live as it is written; ``build`` as in ``apply_batch``.
    One stream writes to a root."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        apply_batch(batch, root, epoch, index, **build)

    writer = stream_lines(spark, src_dir, max_files_per_trigger).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the builds under ``root`` that the live dataset does not refer to: merged runs, replaced snapshots, leavings
    of failed batches.  For a time when no batch is being written and no reader uses an older snapshot."""
    build = P.current_build(spark, root)
    keep = {build, *P.build_runs(spark, root, build)} if build else set()
    builds = set()
    for place in ("builds", "meta"):
        fs, folder, _ = P._fs(spark, f"{root.rstrip('/')}/{place}")
        for status in fs.listStatus(folder) if fs.exists(folder) else ():
            name = status.getPath().getName()
            if not name.startswith(".") and not name.endswith(".tmp"):
                suffix = next((x for x in (*P.SIDE_TABLES, *P.META) if x and name.endswith(x)), "")
                builds.add(name[:len(name) - len(suffix)])
    gone = sorted(builds - keep)
    for one in gone:
        P.delete_build(spark, root, one)
    return gone
