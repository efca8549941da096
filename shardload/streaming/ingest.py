"""Incremental ingest of the line format (S1) with Structured Streaming.

New text files in a folder are parsed, routed and written as they arrive.
The transformation is stateless (no watermark, no state store); each
micro-batch runs the batch build on its rows and writes them under
``batch_id=<epoch>``, overwriting that folder when Spark replays a batch
after a failure, so the sink is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shardload import DEFAULT_DELIM, DEFAULT_SHARDS, DEFAULT_TYPE
from shardload.plans.build import shard_docs
from shardload.sources.lines import with_doc_key


def stream_lines(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(src_dir).select("value", F.col("_metadata.file_path").alias("_file"))


def ingest_stream(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, index: str,
                  doc_type: str = DEFAULT_TYPE, delim: str = DEFAULT_DELIM, auto_id: bool = False,
                  shards: int = DEFAULT_SHARDS, split: int = 1, on_error: str = "fail",
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Start the ingest; ``available_now`` processes what is there and stops.

    ``_doc`` is ``<batch>-<line key>``, so it is unique over all batches.  A bad
    value fails the batch (``fail``), or its document is written marked in
    ``_bad`` (``reject``; see ``fields.kept`` and ``fields.rejected``)."""

    def write_batch(batch: DataFrame, epoch: int) -> None:
        lines = with_doc_key(batch).withColumn("_doc", F.concat(F.lit(f"{epoch}-"), F.col("_doc").cast("string")))
        docs = shard_docs(lines, index, doc_type, delim=delim, auto_id=auto_id, on_error=on_error,
                          shards=shards, split=split)
        (docs.write.mode("overwrite").format(fmt).partitionBy("shard_id")
         .save(f"{out_dir.rstrip('/')}/batch_id={epoch}"))

    writer = stream_lines(spark, src_dir, max_files_per_trigger).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
