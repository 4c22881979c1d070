"""A corpus from raw documents: rules, languages, near duplicates, benchmarks, token ids.

Each stage gets the documents that the one before kept. All but the last return the columns
of ``documents``. Null, empty, very long, repeated and clashing input is handled as the
operators' docstrings say; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterflow.llm import decontaminate, jaccard_join, language_id, pieces, quality_rules, work

#: A language is believed from this probability on.
LEAST_SCORE = 0.5


def _where(docs: DataFrame, made: Column, test: Callable[[str], Column], lang: Callable[[str], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass ``test`` on the struct ``made``, with their own columns only.

    ``lang`` gives a null ``lang`` another value. Both get the struct's name.
    """
    rows, name = work.beside(docs, made)
    own = [work.quoted(c) if c != "lang" or lang is None else F.coalesce(work.quoted(c), lang(name)).alias(c) for c in docs.columns]
    return rows.where(test(name)).select(*own)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep; texts without words go."""
    return _where(docs, quality_rules.measured(F.col("text")), lambda of: quality_rules.verdicts(of)[1])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised among those of the labelled ones; a null ``lang`` becomes it.

    Texts without a letter go, and those that fit no language better than all others together.
    Without any labelled document nothing is recognised.
    """
    automata = language_id.learn(docs.where(~language_id.is_held_out()))
    known = language_id.recognised(spark, automata)(F.col("text"))
    test = lambda of: (F.col(f"{of}.lang_pred") != language_id.UNKNOWN) & (F.col(f"{of}.score") >= LEAST_SCORE)
    return _where(docs, known, test, lambda of: F.col(f"{of}.lang_pred"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows whole in one column, beside their id and the hash of their text."""
    return docs.select(F.struct(*(work.quoted(c) for c in docs.columns)).alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"), F.xxhash64("text").alias("_text_key"))


def _rows(keyed: DataFrame, columns: list[str]) -> DataFrame:
    return keyed.select(*(F.col("_row").getField(c).alias(c) for c in columns))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each component of near duplicates.

    Of rows of one id and text it is the one whose other columns come first as JSON text, by
    a hash of it and then the text itself; which row that is depends on nothing else.
    """
    found = jaccard_join.near_duplicates(docs)
    stay = found.where("stays").select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.col("text_key").alias("_text_key")).distinct()
    others = F.to_json(F.struct(*(work.quoted(c) for c in docs.columns if c not in ("doc_id", "text"))))
    rows, name = work.beside(docs, others)
    keyed = _keyed(docs=rows)
    own = F.col("_row").getField(name)
    place = F.row_number().over(Window.partitionBy("_id", "_text_key").orderBy(F.xxhash64(own), own))
    return _rows(keyed.withColumn("_place", place).where("_place = 1").join(stay, ["_id", "_text_key"], "left_semi"), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 is in windows of benchmark items."""
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.where(decontaminate.contaminated()).select(F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.col("text_key").alias("_text_key")).distinct()
    return _rows(_keyed(docs).join(bad, ["_id", "_text_key"], "left_anti"), docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_ids, ids, restored``: the pieces of each document, and whether they decode to its text."""
    return pieces.encode_documents(docs, pieces.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_by_rules),
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

#: Language identification and segmentation are not expressible; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
