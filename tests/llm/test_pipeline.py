"""The pipeline over the smallest tables, and its edge cases."""

import corpus_pipeline
import pytest


def test_pipeline_on_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert 0.5 * docs.count() < len(ids) < docs.count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_hard_and_empty_tables(spark, docs, empty, name, stage):
    columns = ["doc_id", "n_tokens", "ids"] if name == corpus_pipeline.STAGES[-1][0] else docs.columns
    for df in (docs, empty):
        out = stage(spark, df, "/root/testdata/sf0.001")
        assert out.columns == columns
        assert out.count() <= df.count()
