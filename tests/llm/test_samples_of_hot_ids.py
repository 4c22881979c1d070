"""A sample has one row of an id, however many the table has."""

from __future__ import annotations

import pytest

from rosterflow.llm import cotraining, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, f"text {k % 7}" if k % 7 else None) for k in range(200)] + [(k, f"other {k}") for k in range(2, 12)] + [(None, "nameless")]
    return spark.createDataFrame([(i, t, None, "s", 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 9)], "doc_id long, quality int, toxic int")


def test_one_row_of_each_labelled_id(docs, labels):
    for sample in (cotraining.sample(docs, labels, "quality"), toxicity.sample(docs, labels)):
        found = sample.collect()
        assert sorted(r.doc_id for r in found) == list(range(1, 9))
        assert {r.doc_id: r.y for r in found} == {k: k % 2 for k in range(1, 9)}
        rows = {(r.doc_id, r.text) for r in docs.collect()}
        assert all((r.doc_id, r.text) in rows for r in found)
        assert sorted(map(repr, sample.repartition(7).collect())) == sorted(map(repr, found))
