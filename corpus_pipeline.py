"""Corpus pipeline: documents to packed token sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; all but the last return the columns of ``docs``.  Between stages the rows
are written as Parquet to the shared folder and read back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardload.llm import decontamination, line_dedup, near_dedup, packing, quality
from shardload.llm.common import id_bucket, saved
from shardload.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.7).
    Labels of ids whose crc32 modulo 4 is 2 are never learned."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), id_bucket(F.col("doc_id"), 4) != 2)
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without their source's boilerplate lines; ``n_chars`` follows the text.
    Copies count as one page, so that a large group of them is left for the next stage."""
    clean = line_dedup.drop_boilerplate(docs, copies_once=True)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group (five-word shingles, similarity 0.8)."""
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned scores and MinHash groups have no SQL form; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
