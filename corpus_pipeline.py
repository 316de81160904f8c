"""From raw documents to packed sequences, in five stages.

Each stage is ``f(spark, docs, sf_dir) -> DataFrame``; what it returns is
written as Parquet and read again as the next one's ``docs``. All but the
last return the rows they keep with the columns of ``documents``:

* language ID drops documents that no learned language explains;
* near-dedup keeps one document of each group of near-duplicates;
* decontamination drops documents that share a ten-word window with a test item;
* secret scans drop documents that hold a secret;
* packing returns the pieces of fixed-length token sequences.

Nulls, empty texts, repeated rows and empty tables are handled as each
operator's docstring says; further columns of ``documents`` go through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabkit.llm import decontaminate, language_id, near_dedup, packing, secrets
from tabkit.scratch import Scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs, language_id.train(language_id.learnable(docs, "doc_id", 4, 2)))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("packing", packing_stage),
]

# The language models, and the choice among equally good packings, are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = tables.table(stage(spark, docs, sf_dir), name)
    return docs
