"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardload.llm import centroids, conversation_trie, decontamination, hamming_topk, language_id, license_scan, line_dedup, lm_score, near_dedup, packing, pii, quality, token_counts
from shardload.llm.common import id_bucket
from shardload.sources.tables import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 5) == 0
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model,
                               keep=("doc_id", "held_out"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, counts=True).drop("source")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_topk.vector_topk(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 5) == 1
    model, words = lm_score.fit(docs, ~held_out, public_tokenizers.path("word_bpe_49k.json"), vocabulary=49_408)
    scored = lm_score.score(docs, model, words)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_bucket(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return (quality.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=("doc_id", "held_out"))
            .withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(table(spark, sf_dir, "conversations"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontamination, op3_line_dedup, op4_license_scan, op5_hamming_topk, op6_packing, op7_pii, op8_lm_score,
    op9_near_dedup, op10_quality, op11_conversation_trie, op12_token_counts, op13_centroids)}

ORACLES = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op5_hamming_topk": hamming_topk.ORACLE,
    "op11_conversation_trie": conversation_trie.ORACLE,
    "op13_centroids": centroids.ORACLE,
}
