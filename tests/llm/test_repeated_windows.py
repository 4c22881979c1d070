"""Items and documents that repeat themselves, and items that share one passage."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from rosterflow.llm import decontaminate
from tests.llm.conftest import prose, rows_of


def found(docs, items):
    hits = decontaminate.find_contamination(docs, items)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", decontaminate.contaminated().alias("contaminated"))


def test_one_word_and_shared_passages(spark, sql):
    passage = prose(2, 60)
    items = [(1, "again " * 300), (2, "Again " * 13), (3, "a b " * 50)] + [(10 + k, f"own{k} {passage} own{k}") for k in range(40)]
    texts = ["again " * 900, "again " * 12, "a b " * 200 + passage, f"x {passage} y", passage.replace(" ", "  ", 3), prose(9, 400) + " again" * 20, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(found(docs, bench)) == sql(decontaminate.SQL, documents=docs, benchmark=bench)


def test_a_thousand_items_of_one_passage(spark):
    passage = prose(2, 60)
    bench = spark.createDataFrame([(k, f"own{k} {passage} own{k}") for k in range(1000)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {passage} y"), (2, prose(5, 60))], "doc_id long, text string")
    got = {r.doc_id: r for r in found(docs, bench).collect()}
    assert got[1].n_items == 1000 and got[1].contaminated and got[2].n_items == 0


def test_repeated_words_take_no_longer_than_others(spark):
    bench = spark.createDataFrame([(1, "again " * 600)], "item_id long, text string")

    def seconds(text: str) -> float:
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begun = time.time()
        found(docs, bench).collect()
        return time.time() - begun

    plain = "".join(f"w{k} " for k in range(6000))
    seconds(plain)
    assert seconds("again " * 6000) < seconds(plain) + 4
