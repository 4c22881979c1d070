"""Lines of several documents against SQL and a plain version, with wide and with saturated filters."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterflow.llm import line_dedup
from tests.llm.conftest import prose, rows_of

SHARED = ["The Same Line Here", "  the same line here\t", "é" * 10, "É" * 10, "é" * 9, "short", "ten chars!", "\x0bten CHARS!\r", "x" * 50_000, "中文" * 5, "", "   "]


@pytest.fixture(scope="module")
def rows(documents):
    r = random.Random(4)
    texts = ["\n".join(r.choice([*SHARED, prose(1000 + r.randrange(40), 12), prose(r.randrange(10**6), 8)]) for _ in range(r.randrange(1, 14))) for _ in range(120)]
    texts += ["same line of all\nsame line of all", "SAME line of all", "\n\n\n", "lone line, twice\nlone line, twice", "a\n", "\na", "x" * 50_000]
    extra = documents.sparkSession.createDataFrame([(7000 - k, t, None, "s", 0) for k, t in enumerate(texts)], documents.schema)
    return documents.unionByName(extra)


def query(docs, **how):
    kept = line_dedup.drop_repeated_lines(docs, **how)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@pytest.mark.parametrize("how", [{}, {"segment_lines": 64}, {"segment_lines": 64, "max_bits": 64}, {"segment_lines": 8, "max_bits": 8}])
def test_against_sql(rows, sql, how):
    assert rows_of(query(rows, **how)) == sql(line_dedup.SQL, documents=rows)


def plain(docs) -> list[tuple]:
    blank, fold = " \t\n\x0b\x0c\r", str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    behind = 2**63
    of = lambda line: line.strip(blank).translate(fold)
    read = [(behind if d.doc_id is None else d.doc_id, (d.text or "").split("\n")) for d in docs.collect()]
    holders: dict[str, set[int]] = {}
    for doc, lines in read:
        for line in lines:
            holders.setdefault(of(line), set()).add(doc)
    out = []
    for doc, lines in read:
        stay = [x for x in lines if not (len(of(x)) >= 10 and len(holders[of(x)]) > 1 and min(holders[of(x)]) != doc)]
        out.append((None if doc == behind else doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def test_repeated_rows_rows_without_an_id_and_clashing_columns(rows):
    nameless = rows.where("doc_id > 6900").withColumn("doc_id", F.lit(None).cast("long"))
    only = rows.limit(0).sparkSession.createDataFrame([(None, "a line without any id", None, None, 0)] * 2, rows.schema)
    same_id = rows.where("doc_id = 12").withColumn("text", F.lit("another text of the id\n" + SHARED[0]))
    many = rows.unionByName(rows.where("doc_id % 3 = 0")).unionByName(nameless).unionByName(only).unionByName(same_id)
    wide = many.select("*", *(F.lit("mine").alias(c) for c in ("row", "SUSPECT", "key", "first", "n_lines", "gone", "_", "a.b", "my col")))
    assert sorted((tuple(r) for r in line_dedup.drop_repeated_lines(wide).collect()), key=repr) == plain(many)


def test_empty_table_and_a_very_long_text(rows, spark):
    assert line_dedup.drop_repeated_lines(rows.where("false")).count() == 0
    text = "\n".join(f"line number {k % 70_000}" for k in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "line number 5\nLine Number 6 \nother")], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got[1].text == text and got[2].text == "" and got[2].n_dropped == got[2].n_lines == 100_000
    assert (got[3].text, got[3].n_dropped) == ("other", 2)


def test_filters_hold_every_hash_and_few_others():
    r = np.random.default_rng(3)
    hashes = np.unique(r.integers(0, 2**63, 20_000, dtype=np.uint64) * np.uint64(2))
    bloom = line_dedup.Bloom(1 << 18)
    bloom.add(hashes[::2])
    assert bloom.holds(hashes[::2]).all() and bloom.holds(hashes[1::2]).mean() < 0.02
    width, packed = line_dedup._pack(hashes)
    assert (line_dedup._unpack(width, packed) == hashes).all()


def test_only_suspects_are_marked(rows):
    keyed = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    again = line_dedup.seen_again(keyed, line_dedup.Filters.of(2_000))
    marked = line_dedup.suspects(keyed, again).selectExpr("size(filter(suspect, s -> s)) as n", "doc_id").where("n > 0")
    assert 0 < marked.count() < 0.8 * rows.count()
