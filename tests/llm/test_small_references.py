"""Languages with hardly any labelled text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterflow.llm import language_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("lang is not null and text is not null")


@pytest.mark.parametrize("stray", ["ok", "hi all", "Guten Tag und bis bald"])
def test_a_stray_row_takes_no_documents(spark, labelled, stray):
    learnt = labelled.where(~language_id.is_held_out()).unionByName(spark.createDataFrame([(-1, stray, "xx")], labelled.schema))
    found = language_id.predict(labelled.where(language_id.is_held_out()), language_id.learn(learnt))
    assert found.where("lang = lang_pred").count() >= 0.98 * found.count() > 0


def test_a_small_language_keeps_its_documents(labelled):
    """English and French with one part of a document each, the others with their full sample."""
    small = F.col("lang").isin("en", "fr")
    learnt = labelled.where(~language_id.is_held_out())
    first = learnt.where(small & (F.length("text") >= 400)).groupBy("lang").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id"))
    found = language_id.predict(labelled.where(language_id.is_held_out()), language_id.learn(learnt.where(~small).unionByName(first, allowMissingColumns=True)))
    own = found.where(small)
    assert own.where("lang = lang_pred").count() >= 0.9 * own.count() > 0


def test_a_stray_row_in_the_pipeline(spark, tmp_path, labelled):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    row = docs.limit(1).withColumns({"doc_id": F.lit(-1).cast("long"), "text": F.lit("ok"), "lang": F.lit("xx")})
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    # half of the languages are not given
    some = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    out = stage(spark, some.unionByName(row), str(tmp_path))
    assert out.where("lang = 'xx' and doc_id >= 0").count() == 0
