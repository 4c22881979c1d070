"""The filters in every order against SQL and a plain simulation."""

from __future__ import annotations

import itertools
import re

import pytest
from pyspark.sql import functions as F

from rosterflow.llm import filter_audit
from tests.llm.conftest import rows_of

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def rows(documents):
    """Texts for each combination of failures, copies in other sources, null and empty texts and sources."""
    spark = documents.sparkSession
    long = " ".join(f"w{k}" for k in range(60))
    more = [long, long, f"{long} #", f"{long} #", "a b " * 60, "A B C D " * 60, "A1 B2 C3", "A1 B2 C3", "#", "", None, long.upper(), f"{long}\x0b{long}\x1c{long}", "é" * 50]
    extra = spark.createDataFrame([(5000 + k, t, None, [None, "", "s1", "s2"][k % 4], 0) for k, t in enumerate(more)], documents.schema)
    return documents.unionByName(extra)


@pytest.fixture(scope="module")
def labels(spark):
    some = [(k, k % 2, (k // 2) % 2) for k in range(0, 60)] + [(5000 + k, 1, k % 2) for k in range(12)]
    return spark.createDataFrame([*some, (12, 0, None), (13, None, 1), (None, 1, 1), (5002, 0, 0), (9999, 1, 1)], LABELS)


def simulated(rows, labels):
    """Each order applied left to right, one document after the other."""
    docs = [r.asDict() for r in rows.collect()]
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 1 and r.doc_id is not None}
    fails = []
    for d in docs:
        text = d["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = d["doc_id"] is not None and any((e["text"] or "") == text and e["doc_id"] is not None and e["doc_id"] < d["doc_id"] for e in docs)
        bad = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search("[#$%&*|]", text)), copy]
        fails.append({f for f, b in zip("ABCDE", bad) if b})
    out, sums = {}, {}
    for part in {d["source"] or "" for d in docs}:
        mine = [k for k, d in enumerate(docs) if (d["source"] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [k for k in left if f in fails[k]]
                stay = [k for k in left if f not in fails[k]]
                redundant = [k for k in mine if f in fails[k] and k not in left]
                ids = [docs[k]["doc_id"] for k in removed]
                out[part, "".join(order), step] = (len(stay), len(removed), len(redundant), sum(fails[k] == {f} for k in mine), sum(i in good for i in ids), sum(i in toxic for i in ids))
                sums[part, f] = sums.get((part, f), 0) + len(removed)
                left = stay
    return sorted((*key, *counts, sums[key[0], key[1][key[2] - 1]]) for key, counts in out.items())


def found(frame):
    return sorted(tuple(r) for r in frame.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def test_against_sql_and_a_simulation(rows, labels, sql):
    got = filter_audit.interactions(rows, labels)
    assert rows_of(got) == sql(filter_audit.SQL, documents=rows, labels=labels)
    assert found(got) == simulated(rows, labels)


def test_repeated_rows_and_rows_without_an_id(rows, labels):
    some = rows.where("doc_id < 25 or doc_id >= 5000")
    nameless = some.withColumn("doc_id", F.lit(None).cast("long"))
    many = some.unionByName(some).unionByName(nameless).unionByName(some.where("doc_id = 12").withColumn("source", F.lit("s9")))
    assert found(filter_audit.interactions(many, labels)) == simulated(many, labels)


def test_empty_tables_and_clashing_columns(rows, labels):
    assert filter_audit.interactions(rows.where("false"), labels).count() == 0
    unlabelled = filter_audit.interactions(rows, labels.where("false"))
    assert unlabelled.where("good_lost <> 0 or toxic_lost <> 0").count() == 0
    names = ("part", "HASH", "fails", "n", "kept", "quality", "Toxic", "first", "bit", "_", "a.b", "my col", "rows")
    wide = rows.select("*", *(F.lit("mine").alias(c) for c in names))
    more = labels.select("*", *(F.lit("mine").alias(c) for c in ("part", "hash", "Rows", "a.b", "text")))
    assert found(filter_audit.interactions(wide, more)) == found(filter_audit.interactions(rows, labels))


def test_very_long_texts(spark, labels):
    text = " ".join(f"w{k % 500}" for k in range(60_000))
    rows = spark.createDataFrame([(k, text if k < 30 else text + f" {k % 3}", "s") for k in range(60)], "doc_id long, text string, source string")
    assert found(filter_audit.interactions(rows, labels.where("false"))) == [
        ("s", "".join(o), s, *c) for o in sorted(itertools.permutations("ABCDE")) for s, c in _steps_of_copies(o)
    ]


def _steps_of_copies(order):
    """60 long texts of four kinds, which all fail B; 56 are copies."""
    left, gone = 60, {"B": False, "E": False}
    for step, f in enumerate(order, 1):
        if f == "B":
            removed, redundant = left, 60 - left
            left = 0
        elif f == "E":
            removed = 56 if left else 0
            redundant = 56 - removed
            left -= removed
        else:
            removed = redundant = 0
        shapley = {"B": 4 * 120 + 56 * 60, "E": 56 * 60}.get(f, 0)
        yield step, (left, removed, redundant, 4 if f == "B" else 0, 0, 0, shapley)
