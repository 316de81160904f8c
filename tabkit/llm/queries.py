"""The operators bound to the driver tables: one query per operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabkit.llm import decontaminate, divergence, html_text, language_id, merkle, near_dedup, packing, quality, secrets, substring_dedup, suffix_dedup, token_counts, toxicity


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, matches = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return decontaminate.digest(documents, matches)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    found = substring_dedup.passages(substring_dedup.repeated_spans(docs), substring_dedup.row_copies(docs))
    return found.select(F.col("id").alias("doc_id"), "copy", "start", "end", "n_words", "n_units", "removed", F.col("first_ids").alias("first_doc_ids"), "clusters")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(_read(spark, sf_dir, "documents"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_read(spark, sf_dir, "documents")).drop("text_hash")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    learned = language_id.train(language_id.learnable(docs, "doc_id", 4, 2))
    return language_id.predict(docs, learned).select(
        "doc_id", language_id.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected", "entropy")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    learned = toxicity.train_joined(language_id.learnable(docs, "doc_id", 5, 0), _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, learned).select("doc_id", language_id.held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_read(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_secret_scans, op2_decontamination, op3_substring_dedup, op4_html_extraction, op5_quality_rules,
                                   op6_near_dedup, op7_language_id, op8_token_counts, op9_toxicity, op10_packing,
                                   op11_merkle_manifest, op12_source_divergence, op13_suffix_dedup)}
SQL = {"op1_secret_scans": secrets.oracle_sql(), "op11_merkle_manifest": merkle.oracle_sql(), "op12_source_divergence": divergence.oracle_sql()}
