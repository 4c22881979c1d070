"""Keys that many sets of different components share: passages that go round, not texts."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from rosterflow.llm import jaccard_join
from tests.llm.conftest import edited, prose, rows_of


def _of_passages(n: int, of: int, n_words: int = 40) -> list[str]:
    r = random.Random(n)
    passages = [" ".join(f"w{r.randrange(5000)}" for _ in range(n_words)) for _ in range(n)]
    return [" ".join(passages[j] for j in chosen) for chosen in itertools.combinations(range(n), of)]


def _table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("seed", range(4))
def test_sets_that_link_share_an_atom_key(seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MOST_KEYS", (5, 40, 256, 256)[seed])
    r = np.random.default_rng(seed)
    weights = r.integers(1, 30 if seed % 2 else 3, 60)
    atom = r.integers(-(2**62), 2**62, 60)
    held = r.integers(2, 9, 60)
    linked = 0
    for _ in range(400):
        base = r.random(60) < r.choice([0.05, 0.2, 0.6])
        pair = [base ^ (r.random(60) < 0.05) for _ in "ab"]
        alone = r.integers(0, 4, 2)
        sizes = [int(weights[p].sum() + a) for p, a in zip(pair, alone)]
        both = int(weights[pair[0] & pair[1]].sum())
        if not both or 100 * both < 75 * (sum(sizes) - both):
            continue
        linked += 1
        least = -(-75 * sum(sizes) // 175)
        for k in range(1, jaccard_join.MOST_K + 1):
            sides = [jaccard_join.atom_keys(n, held[p], atom[p], weights[p], k) for n, p in zip(sizes, pair)]
            near = [set(key[level <= n - least + 1].tolist()) for n, (key, level, _) in zip(sizes, sides)]
            assert near[0] & near[1]
            if sides[0][2] or sides[1][2]:
                break
        else:
            raise AssertionError("no set left")
    assert linked > 50


def test_all_pairs_by_atoms(spark, documents, sql, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CROWD", 0)
    monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 0)
    for docs in (documents, _table(spark, [edited(t, k, 0.01 * (k % 4)) for k, t in enumerate(_of_passages(6, 4, 12) * 4)] + [prose(9, 60)] * 3)):
        got = jaccard_join.near_duplicates(docs, block_chars=10_000).select("doc_id", "n_shingles", "component_id")
        assert rows_of(got) == sql(jaccard_join.SQL, documents=docs)


@pytest.mark.parametrize("n", [10, 14])
def test_pairs_of_shared_passages_are_few(spark, n, monkeypatch):
    """Texts of 4 of ``n`` passages, none similar enough: 3 of 4 passages in common are a Jaccard of 0.6."""
    across, pairs = jaccard_join._across, []

    def counted(*given):
        found = across(*given)
        pairs.append(found.distinct().count())
        return found

    monkeypatch.setattr(jaccard_join, "_across", counted)
    texts = _of_passages(n, 4)
    got = jaccard_join.near_duplicates(_table(spark, texts))
    assert got.where("doc_id <> component_id").isEmpty()
    assert sum(pairs) < 5 * len(texts)
