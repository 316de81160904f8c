"""The pipeline over the small driver tables, stage by stage."""

import corpus_pipeline
from tabkit.scratch import Scratch
from tests.conftest import SF001


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, rows, tables = docs.columns, docs.count(), Scratch(spark, "test-pipeline")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.table(stage(spark, docs, SF001), name)
        assert docs.columns == columns and 0 < docs.count() <= rows
        rows = docs.count()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids
