"""The search for pseudo-labels covers all unlabelled documents."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterflow.llm import cotraining, linear

SF = "/root/testdata/sf0.1"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _models(views):
    """Of any weights, sure of some documents of both classes."""
    r = np.random.Generator(np.random.PCG64(7))
    weights = [r.normal(size=x.shape[1]) * scale for x, scale in zip(views, (400, 20))]
    return [linear.Logistic(w, -float(np.median(x @ w))) for w, x in zip(weights, views)]


def test_the_surest_of_all_unlabelled_documents_are_found(spark):
    """Two rounds against a plain search over the logits of all rows."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select(*COLUMNS), spark.read.parquet(f"{SF}/labels.parquet")
    told = cotraining._labels(labels, "quality")
    search, used, least = cotraining.Search(docs, told), set(), np.log(cotraining.SURE / (1 - cotraining.SURE))
    free = docs.join(told, "doc_id", "left_anti").toArrow().combine_chunks()
    views = [np.concatenate(x) for x in zip(*((c, m) for b in free.to_batches() for _, c, m in cotraining._views(b)))]
    models = _models(views)
    logits = [np.round(m.logit(x), 6) for m, x in zip(models, views)]
    assert free.num_rows > 3000
    for _ in range(2):
        found, new = search(models, 150), set()
        for v in (0, 1):
            left = np.array([k for k in range(free.num_rows) if k not in used])
            for label, n in ((1, 150), (0, 50)):
                value = logits[v][left] * (1 if label else -1)
                best = left[np.argsort(-value, kind="stable")][:n]
                best = best[(logits[v][best] * (1 if label else -1)) >= least]
                got = found[v][0][v][found[v][1] == label]
                own = np.sort(models[v].logit(got))
                assert len(got) == len(best) > 0 and np.abs(own - np.sort(logits[v][best])).max() < 1e-4
                new |= set(best.tolist())
        used |= new


def test_a_document_is_found_once(spark):
    rows = [(1, "labelled"), *((2, f"copy {k % 2}") for k in range(60)), *((k, f"text {k} of many words") for k in range(10, 20)), *((None, f"nameless {k % 2}") for k in range(6))]
    docs = spark.createDataFrame([(i, t, None, "s", 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (99, 0)], "doc_id long, quality int")
    models = [linear.Logistic(np.zeros(n), 9.0) for n in (1 << cotraining.CONTENT_BITS, cotraining._META)]
    search = cotraining.Search(docs, cotraining._labels(labels, "quality"))
    assert search.logits(models).count() == 1 + 10 + 2
    (found, label), _ = search(models, 100)
    assert len(label) == 13 and label.all() and [len(x) for x in found] == [13, 13]
    assert all(len(label) == 0 for _, label in search(models, 100))
