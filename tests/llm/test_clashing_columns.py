"""Extra columns of any name, and rows that differ in other columns only."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterflow.llm import cotraining, decontaminate, jaccard_join, language_id, lm_score, pieces, quality_rules, toxicity
from tests.llm.conftest import prose, rows_of

NAMES = ("N_WORDS", "Score", "LANG_PRED", "P_Toxic", "GOOD", "Ids", "_", "a.b", "my col", "made", "b`t", "Key", "Doc_Key", "TEXT_KEY")


@pytest.fixture(scope="module")
def odd(documents):
    return documents.select("*", *(F.lit("mine").alias(c) for c in NAMES))


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([(10, 1, 1), (11, 0, 0), (12, 1, 0), (14, 0, 1)], "doc_id long, quality int, toxic int")


def test_results_replace_columns_of_their_names_in_any_case(documents, odd, few):
    model = pieces.Model.load(pieces.tokenizer_path())
    runs = {
        "n_words": quality_rules.judge,
        "score": lambda d: language_id.predict(d, language_id.learn(documents)),
        "p_toxic": lambda d: toxicity.score(d, toxicity.learn(documents, few)),
        "good": lambda d: cotraining.score(d, cotraining.learn(documents, few)),
        "ids": lambda d: pieces.encode(d, model),
    }
    for name, run in runs.items():
        got = run(odd)
        assert [c for c in got.columns if c.lower() == name] == [name]
        assert {"_", "a.b", "my col", "made", "b`t"} <= set(got.columns)
        assert got.where("`a.b` = 'mine' and `my col` = 'mine' and `b``t` = 'mine'").count() == documents.count()
        assert rows_of(got.select("doc_id", name)) == rows_of(run(documents).select("doc_id", name))


def test_other_operators_ignore_extra_columns(documents, odd, items):
    for run in (lm_score.score_documents, jaccard_join.near_duplicates, lambda d: decontaminate.find_contamination(d, items).drop("begins", "ends", "items")):
        assert rows_of(run(odd)) == rows_of(run(documents))


def test_pipeline_with_odd_columns(spark, tmp_path, odd, items):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd.columns
        assert docs.where("`a.b` <> 'mine' or N_WORDS <> 'mine' or `b``t` <> 'mine'").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == docs.count() > 0


def test_the_row_that_stays_does_not_depend_on_partitions(spark):
    text = prose(77, 60)
    rows = [(1, text, "en", f"s{k}", k) for k in range(8)] + [(2, text + " end", "en", f"t{k}", k) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [rows_of(corpus_pipeline.keep_one_of_near_duplicates(spark, docs.repartition(n, *keys), "")) for n, keys in ((1, ["source"]), (5, ["source"]), (3, ["n_chars"]), (1, ["n_chars"]))]
    assert len(kept[0]) == 1 and all(k == kept[0] for k in kept)
