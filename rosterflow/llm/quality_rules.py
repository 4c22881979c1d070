"""Rules on how much of a document repeats itself.

The n-grams of several lengths of each document are hashed by a sum of word hashes times
powers (``words.ngrams``), all in numpy over runs of whole texts. The rules measure which
share of a document's word characters lies inside n-grams that it holds twice or more, and
inside lines that equal an earlier line.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import words, work

MIN_WORDS = 10
BASE_LENGTH = 5
#: A document passes the base rule with at most this many percent of its words in repeated windows.
BASE_PERCENT = 20
#: n-gram lengths, and the greatest share of word characters inside repeated n-grams of each.
MAX_SHARE = {5: 0.20, 6: 0.20, 8: 0.20, 10: 0.20}
#: The greatest share of word characters inside lines that equal an earlier one.
MAX_LINE_SHARE = 0.30

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_NEW_CHAR = np.ones(256, np.int64)
_NEW_CHAR[0x80:0xC0] = 0  # bytes inside a character
MEASURES = pa.schema(
    [(name, pa.int64()) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")]
    + [(f"dup_{n}gram_chars", pa.int64()) for n in MAX_SHARE]
)
DDL = ", ".join(f"{name} long" for name in MEASURES.names)


def _repeats(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (group, value) occur again, and which have occurred before."""
    order = np.lexsort((value, group))  # stable, so earlier places come first
    same = np.zeros(len(order), bool)
    same[1:] = (group[order[1:]] == group[order[:-1]]) & (value[order[1:]] == value[order[:-1]])
    after = np.zeros(len(order), bool)
    after[:-1] = same[1:]
    twice, earlier = np.empty(len(order), bool), np.empty(len(order), bool)
    twice[order] = same | after
    earlier[order] = same
    return twice, earlier


def _between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return sums[end] - sums[start]


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def measure(texts: pa.Array) -> pa.Table:
    """The measures of each text; all are 0 for null, empty and blank texts."""
    raw, at = words.utf8(texts)
    parts = [_measure(raw[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in words.runs(at)]
    return pa.concat_tables(parts) if parts else MEASURES.empty_table()


def _measure(raw: np.ndarray, at: np.ndarray) -> pa.Table:
    n = len(at) - 1
    found = words.split(raw, at, words.NOT_SPACE)
    hashes = found.hashes()
    chars = _running(_NEW_CHAR[raw])
    own = _between(chars, found.start, found.end)
    total = lambda values: _between(_running(values), found.first[:-1], found.first[1:])

    def covered(length: int) -> np.ndarray:
        """The words inside n-grams that their text holds twice or more."""
        start = np.flatnonzero(words.within(found.text, length))
        grams = words.ngrams(hashes, length)
        twice, _ = _repeats(found.text[start], grams[start] if len(start) else grams[:0])
        edge = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edge, start[twice], 1)
        np.add.at(edge, start[twice] + length, -1)
        return np.cumsum(edge[:-1]) > 0

    starts, ends = _lines(raw, at)
    full = np.searchsorted(found.start, starts) < np.searchsorted(found.start, ends)
    starts, ends = starts[full], ends[full]
    text = np.searchsorted(at, starts, "right") - 1
    _, earlier = _repeats(text, words.range_hashes(raw, starts, ends))
    word_sums = _running(own)
    line_chars = _between(word_sums, np.searchsorted(found.start, starts), np.searchsorted(found.start, ends))
    base = covered(BASE_LENGTH)
    columns = [
        np.diff(found.first),
        total(own),
        _between(_running(_SYMBOL[raw]), at[:-1], at[1:]),
        np.bincount(text[earlier], minlength=n),
        total(base),
        np.bincount(text[earlier], line_chars[earlier], n).astype(np.int64),
        *(total(np.where(base if length == BASE_LENGTH else covered(length), own, 0)) for length in MAX_SHARE),
    ]
    return pa.table([pa.array(c, pa.int64()) for c in columns], schema=MEASURES)


def _lines(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges between line ends and text ends that hold a byte."""
    breaks = np.flatnonzero(raw == 0x0A)
    starts = np.sort(np.concatenate([at[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([at[1:], breaks]))
    return starts[starts < ends], ends[starts < ends]


def measured(text: Column) -> Column:
    """A struct of the measures of ``text``."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        for texts in batches:
            yield measure(texts)

    return work.of_text(run, StructType.fromDDL(DDL))(text)


def verdicts(of: str = "") -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` from columns, or fields of the struct ``of``, that bear the measures' names."""
    m = {name: F.col(f"{of}.{name}" if of else name) for name in MEASURES.names}
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
    over = m["dup_line_chars"] > MAX_LINE_SHARE * m["word_chars"]
    for n, share in MAX_SHARE.items():
        over = over | (m[f"dup_{n}gram_chars"] > share * m["word_chars"])
    return base, ~(base | over)


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept``.

    ``kept`` is false where the base rule fails, where a length of ``MAX_SHARE`` covers
    more than its share of the word characters, or where repeated lines hold more than
    ``MAX_LINE_SHARE``. A null, empty or blank text has no words and fails the base rule; a
    text of any length is read whole. Columns of ``docs`` that bear a name of the results, in
    any case, are replaced. Rows are judged one by one, so repeated rows get equal results
    and an empty table gives none.
    """
    results = {"base_failed", "kept"}
    others = docs.select(*(work.quoted(c) for c in docs.columns if c.lower() not in results))
    base, kept = verdicts()
    return work.with_fields(others, measured(F.col("text")), MEASURES.names).select("*", base.alias("base_failed"), kept.alias("kept"))


def op6_repetition_rules(spark, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return judged.drop("text")


def _covered_sql(n: int) -> str:
    return f"""
win{n} AS (SELECT doc_id, p, array_to_string(w[p:p + {n - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n - 2})) AS p FROM t)),
hit{n} AS (SELECT DISTINCT doc_id, unnest(range(p, p + {n})) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win{n}) WHERE c > 1),
cov{n} AS (SELECT doc_id, count(*) AS words{n}, sum(length(w[p])) AS chars{n} FROM hit{n} JOIN t USING (doc_id) GROUP BY doc_id),"""


_JOINS = " ".join(f"LEFT JOIN cov{n} USING (doc_id)" for n in MAX_SHARE)
_CHARS = ", ".join(f"coalesce(chars{n}, 0)::BIGINT AS dup_{n}gram_chars" for n in MAX_SHARE)
_OVER = " OR ".join(f"dup_{n}gram_chars > {share} * word_chars" for n, share in MAX_SHARE.items())
SQL = rf"""
WITH t AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
{"".join(_covered_sql(n) for n in MAX_SHARE)}
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM l WHERE k > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dl.n, 0)::BIGINT AS n_dup_lines,
    coalesce(words{BASE_LENGTH}, 0)::BIGINT AS n_repeat_words, coalesce(dl.chars, 0)::BIGINT AS dup_line_chars, {_CHARS}
  FROM t LEFT JOIN dl USING (doc_id) {_JOINS}),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT (base_failed OR dup_line_chars > {MAX_LINE_SHARE} * word_chars OR {_OVER}) AS kept FROM b
"""
