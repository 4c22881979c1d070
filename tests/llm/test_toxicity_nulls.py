"""A null text among the documents labelled toxic."""

from __future__ import annotations

from rosterflow.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_a_null_text_labelled_toxic_loses_no_toxic_document(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    docs = docs.unionByName(spark.createDataFrame([(-1, None)], docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(-1, None, 1)], "doc_id long, quality int, toxic int"))
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).join(labels.withColumnRenamed("toxic", "y"), "doc_id").toPandas()
    assert scored[["p_quality", "p_toxic"]].notna().all().all()
    caught = scored[scored.text.notna() & (scored.y == 1)].toxic
    assert len(caught) and caught.sum() >= 0.8 * len(caught)
    assert not scored[scored.text.isna()].toxic.any()
    assert (scored.toxic & (scored.y == 0)).sum() <= 0.01 * len(scored)
