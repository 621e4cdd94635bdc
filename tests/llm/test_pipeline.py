import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attestry.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_keep_columns_and_clean_documents(spark, tmp_path):
    clash = ("score", "lang_pred", "n_lines", "n_removed", "bucket", "row_id", "component_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(f"kept {c}") for c in clash})
    n = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == docs.columns
            assert 0.8 * n <= out.count() <= docs.count()
            assert all(out.where(F.col(c) != f"kept {c}").count() == 0 for c in clash)
        docs = out
    assert docs.agg(F.sum("taken")).first()[0] > 0


def test_stages_on_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words of a text that is long enough", "en", None, 4), (3, "the words of the text and more", None, "a", 3), (3, "the words of the text and more", None, "a", 3)]
    for tag, docs in (("odd", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")), ("none", spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= len(rows)
            if name != "mixing":
                assert out.columns == docs.columns


def test_every_query_is_registered(spark):
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 11)] == [1] * 10 and "pipeline" in QUERIES
