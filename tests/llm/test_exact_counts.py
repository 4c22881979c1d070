"""Counts of n-grams whose hashes begin alike."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterflow.llm import lm_score, tally, words
from tests.llm.conftest import rows_of


def _alike(bits: int) -> tuple[str, str]:
    """Two words whose hashes have the same first bits."""
    names = [f"w{k}" for k in range(40_000)]
    raw, at = words.utf8(pa.array(names))
    hashes = words.ngrams(words.split(raw, at, words.NOT_SPACE).hashes(), 1) >> np.uint64(64 - bits)
    order = np.argsort(hashes, kind="stable")
    k = int(np.flatnonzero(hashes[order][1:] == hashes[order][:-1])[0])
    return names[order[k]], names[order[k + 1]]


@pytest.mark.parametrize("block_chars", [10, 1_000_000])
def test_words_with_hashes_alike_are_counted_apart(spark, sql, block_chars):
    one, other = _alike(26)
    docs = spark.createDataFrame([(1, f"{one} a b a"), (2, f"{other} c {one}"), (3, f"{other} d"), (4, f"{other} b")], "doc_id long, text string")
    mean = F.round(F.col("log10_score") / F.col("n_words"), 4).alias("mean_log10")
    got = lm_score.score_documents(docs, block_chars=block_chars).select("doc_id", "n_words", mean, "n_backoffs")
    assert rows_of(got) == sql(lm_score.SQL, documents=docs)


@pytest.mark.parametrize("n", [1, 2, 7, 3750])
def test_buckets_hold_all_hashes_of_64_bits(n):
    plan = tally.Plan(n, 64)
    hashes = np.array([0, 1, 2**63, 2**64 - 2, 2**64 - 1], np.uint64)
    bucket = plan.bucket(plan.short(hashes))
    assert bucket.min() == 0 and bucket.max() <= n
    assert all(0 <= int(h) - int(b) * plan.step < 2**64 and int(b) * plan.step < 2**64 for h, b in zip(hashes, bucket))


def _plain(texts: list[str | None], least: int) -> list[tuple[int, float | None, int]]:
    """(words, score, backoffs) of each text, word by word from the definition."""
    docs = [(t or "").lower().split() for t in texts]
    counts = Counter(tuple(d[i : i + k]) for d in docs for k in (1, 2, 3) for i in range(len(d) - k + 1))
    total, out = sum(map(len, docs)), []
    for doc in docs:
        score, backoffs = 0.0, 0
        for i in range(len(doc)):
            for k in range(min(3, i + 1), 0, -1):
                gram = tuple(doc[i - k + 1 : i + 1])
                if k == 1 or counts[gram] >= least:
                    score += math.log10(counts[gram] / (counts[gram[:-1]] if k > 1 else total))
                    break
                score, backoffs = score + math.log10(0.4), backoffs + 1
        out.append((len(doc), round(score, 6) if doc else None, backoffs))
    return out


@pytest.mark.parametrize("least", [1, 2, 3])
@pytest.mark.parametrize("block_chars", [30, 1_000_000])
def test_scores_follow_the_definition_at_every_least_count(spark, least, block_chars):
    texts = ["a b c a b c a b d", "A b c d e", "x", "", None, "a b c a b d \u00fc \u00fc", "b c " * 300, "only once here", "a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lm_score.score_documents(docs, block_chars=block_chars, min_count=least).orderBy("doc_id").collect()
    assert [(r.n_words, None if r.log10_score is None else round(r.log10_score, 6), r.n_backoffs) for r in got] == _plain(texts, least)


@pytest.mark.parametrize("packed", [False, True])
def test_counts_and_texts_come_back_from_the_exchange(spark, packed):
    plan = tally.Plan(3, 64, packed)
    counts = np.array([0, 1, 254, 255, 256, 2**40], np.int64)
    assert plan.unpack_counts(*plan.pack_counts(counts)).tolist() == counts.tolist()
    texts = ["", None, "\u00e4\n", "a" * 5000, "\ud55c\U0001f600"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    blocks = plan.blocks(docs).toArrow().sort_by("doc_id")
    assert plan.opened(blocks)["text"].to_pylist() == texts
