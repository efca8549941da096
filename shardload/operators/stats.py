"""Statistics over built documents.

Distinct counts per document are taken where the document is (in batches,
``functions.field_sums``), so no aggregation needs a document-key shuffle and
a hot id or field costs only partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardload.functions.field_sums import partial_sums
from shardload.session import materialize

STATE = ("doc_count", "sum_doc_freq", "sum_total_term_freq", "min_l", "max_l", "min_d", "max_d")


def field_states(docs: DataFrame, by_shard: bool = True) -> DataFrame:
    """G1 as partial states: ``(shard_id, name, type, doc_count, …, max_d)``, and of each shard a row without a name
    whose ``doc_count`` counts its documents.  A document lies in one shard, so states of different shards, or of
    documents added later, add up (``merge_field_states``) without a look at the documents."""
    return _field_rows(docs, ["shard_id"] if by_shard else [])


def merge_field_states(states: DataFrame, shards: list[int] | None = None) -> DataFrame:
    """G1 of a set of shards (None: all) from their stored states; columns as ``field_stats``."""
    own = states if shards is None else states.where(F.col("shard_id").isin(list(shards)))
    max_doc = own.where("name IS NULL").agg(F.sum("doc_count")).first()[0] or 0
    sums = own.where("name IS NOT NULL").groupBy("name", "type").agg(
        *[F.sum(c).alias(c) for c in STATE[:3]], *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in STATE[3:]])
    return sums.select("name", "type", F.lit(max_doc).cast("bigint").alias("max_doc"), *STATE)


def merge_term_states(states: DataFrame, shards: list[int] | None = None) -> DataFrame:
    """D3 of a set of shards from stored ``(shard_id, field, term, df, ttf)``."""
    own = states if shards is None else states.where(F.col("shard_id").isin(list(shards)))
    return own.groupBy("field", "term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))


def field_stats(docs: DataFrame) -> DataFrame:
    """G1: per field and type: ``max_doc`` (documents in the set),
    ``doc_count`` (documents with the field), ``sum_doc_freq`` (distinct
    values summed over documents), ``sum_total_term_freq`` (values), and the
    exact range: ``min_l`` / ``max_l`` of integral, ``min_d`` / ``max_d`` of
    float and double fields.
    """
    # The states have one row per field name and type; they are written once to the
    # checkpoint folder, so the document count (one number) is read without re-running the parse.
    return merge_field_states(materialize(field_states(docs, by_shard=False)))


def _field_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One pass: every batch emits a row for each (name, type) it has, with its distinct values per document, its values
    and their range, and one row without a name for ``max_doc``; a single aggregation adds these partial sums up."""
    sums = partial_sums(docs, *keep).withColumnsRenamed({"own": keep[0]} if keep else {})
    return (sums.groupBy(*keep, "name", "type")
            .agg(F.sum("dc").alias("doc_count"), F.sum("df").alias("sum_doc_freq"), F.sum("ttf").alias("sum_total_term_freq"),
                 *[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in STATE[3:]]))


def duplicate_ids(docs: DataFrame, key: str = "_id") -> DataFrame:
    """Ids carried by more than one document (never merged)."""
    return (docs.groupBy(key).agg(F.count(F.lit(1)).alias("n_docs"))
            .where(F.col("n_docs") > 1))


def manifest(docs: DataFrame, build_id: str, generation: int = 1) -> DataFrame:
    """Per-shard build metadata: documents, distinct ids, id range."""
    return (docs.groupBy("shard_id")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("_id").alias("n_ids"),
                 F.min("_id").alias("min_id"), F.max("_id").alias("max_id"))
            .select(F.lit(build_id).alias("build_id"), "shard_id", F.lit(generation).alias("generation"),
                    "n_docs", "n_ids", "min_id", "max_id"))
