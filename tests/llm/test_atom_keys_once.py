"""Atom keys are made once, though their sizes and their sets are both asked."""

from __future__ import annotations

import uuid
from collections import Counter

from rosterflow.llm import jaccard_join
from tests.llm.test_crowded_keys import _of_passages, _table


def test_atom_keys_are_made_once(spark, monkeypatch, tmp_path):
    made, folder = jaccard_join._atom_key_rows, str(tmp_path)

    def noted(k, batches):
        def seen():
            for batch in batches:
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                    out.write("".join(f"{k} {node}\n" for node in batch["node"].to_pylist()))
                yield batch

        yield from made(k, seen())

    monkeypatch.setattr(jaccard_join, "_atom_key_rows", noted)
    got = jaccard_join.near_duplicates(_table(spark, _of_passages(10, 4)))
    assert got.where("doc_id <> component_id").isEmpty()
    times = Counter(line for path in tmp_path.iterdir() for line in path.read_text().splitlines())
    assert times and set(times.values()) == {1}
