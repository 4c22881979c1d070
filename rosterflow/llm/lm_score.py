"""Stupid-backoff language-model scores of documents.

The model is the corpus itself: counts of all 1- to ``order``-grams of all documents.
N-grams of two words or more that occur fewer than ``min_count`` times in the whole corpus
are not in the tables; with the default of 2 a document's own single n-grams tell nothing
of it, with 1 all are in. A word scores

    S(w | context) = count(context w) / count(context)    if (context w) is in the tables
                     0.4 * S(w | shorter context)         else
    S(w)           = count(w) / number of words

The n-grams of each block of documents are joined to the count tables, which are
partitioned by hash, and their logarithms are summed per document. See ``tally`` for the
exchange that does both in one shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import tally, words, work

ORDER = 3
BACKOFF = 0.4
#: Counts below this are not kept for two words or more, unless a call says otherwise.
MIN_COUNT = 2
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("log10_counts", pa.float64()), ("n_single", pa.int64()), ("n_backoffs", pa.int64())])


def _grams(plan: tally.Plan, table: pa.Table, lo: int, hi: int, order: int):
    raw, at = words.utf8(table["text"].slice(lo, hi - lo))
    found = words.split(words.folded(raw), at, words.NOT_SPACE)
    hashes = found.hashes()
    return found, [(plan.short(words.ngrams(hashes, n)), words.within(found.text, n)) for n in range(1, order + 1)]


def _sums(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, int)
    return hashes[first], np.add.reduceat(counts[order], first) if len(first) else counts


def score_documents(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, block_chars: int = tally.BLOCK_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``doc_id, n_words, log10_score (sum over words), n_backoffs`` of each row of ``docs (doc_id, text)``.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. A null, empty or blank text has
    0 words and the score null. Texts of any length are scored whole. Repeated rows
    count, and are scored, each time. Other columns are ignored; an empty table gives no
    rows. ``min_count`` is 1 or more.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    plan = tally.Plan.of(docs, block_chars, packed=True)
    blocks = plan.blocks(docs)

    def keys(table: pa.Table):
        hashes, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for lo, hi in words.runs(words.utf8(table["text"])[1]):
            _, grams = _grams(plan, table, lo, hi, order)
            h, c = np.unique(np.concatenate([g[whole] for g, whole in grams]), return_counts=True)
            hashes.append(h)
            counts.append(c)
        return _sums(np.concatenate(hashes), np.concatenate(counts))

    def score(table: pa.Table, totals: tally.Totals) -> pa.Table:
        out = []
        for lo, hi in words.runs(words.utf8(table["text"])[1]):
            found, grams = _grams(plan, table, lo, hi, order)
            size = len(found.text)
            below = totals.of(grams[0][0])
            value = np.log10(below)
            steps = np.zeros(size, np.int64)
            single = np.ones(size, bool)
            for k in range(1, order):
                gram, whole = grams[k]
                last = np.flatnonzero(whole) + k  # the scored word of each n-gram
                count = np.zeros(size, np.int64)
                count[last] = totals.of(gram[whole])
                context = np.zeros(size, np.int64)
                context[last] = below[last - 1]
                seen = count >= min_count
                missed = np.zeros(size, bool)
                missed[last] = ~seen[last]
                with np.errstate(divide="ignore", invalid="ignore"):
                    value = np.where(seen, np.log10(count / context), value + missed * np.log10(backoff))
                steps = np.where(seen, 0, steps + missed)
                single &= ~seen
                below = count
            n_own = np.diff(found.first)
            sums = np.zeros(hi - lo)
            np.add.at(sums, found.text, value)
            singles = np.bincount(found.text[single], minlength=hi - lo)
            back = np.bincount(found.text, steps, hi - lo).astype(np.int64)
            out.append(pa.table([table["doc_id"].slice(lo, hi - lo), pa.array(n_own), pa.array(sums), pa.array(singles), pa.array(back)], schema=_OUT))
        return pa.concat_tables(out) if out else _OUT.empty_table()

    answers = tally.totals(blocks, keys, plan)
    parts = work.written(tally.with_totals(blocks, answers, keys, score, "doc_id long, n_words long, log10_counts double, n_single long, n_backoffs long", plan), "lm-scores")
    # the words scored by their own count alone lack the division by the corpus size
    n_words = F.lit(float(parts.agg(F.sum("n_words")).first()[0] or 1))
    score_of = F.when(F.col("n_words") > 0, F.col("log10_counts") - F.col("n_single") * F.log10(n_words))
    return parts.select("doc_id", "n_words", score_of.alias("log10_score"), "n_backoffs")


def op2_stupid_backoff(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_words", F.round(F.col("log10_score") / F.col("n_words"), 4).alias("mean_log10"), "n_backoffs")


# A count of at least 2 is "in the tables"; a bigram's context is the count of its first
# word, a trigram's that of its first two words.
SQL = r"""
WITH tok AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)),
g AS (SELECT doc_id, p, w, lag(w) OVER d AS v, lag(w, 2) OVER d AS u FROM tok WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
c AS (SELECT g.*, count(*) OVER (PARTITION BY w) AS c1, count(*) OVER () AS n,
        CASE WHEN v IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY v, w) END AS c2,
        CASE WHEN u IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY u, v, w) END AS c3 FROM g),
e AS (SELECT c.*, lag(c1) OVER d AS x1, lag(c2) OVER d AS x2 FROM c WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
s AS (SELECT doc_id,
        CASE WHEN c3 >= 2 THEN log10(c3 / x2) WHEN c2 >= 2 THEN log10(c2 / x1) + (u IS NOT NULL)::INT * log10(0.4)
             ELSE log10(c1 / n) + ((u IS NOT NULL)::INT + (v IS NOT NULL)::INT) * log10(0.4) END AS l,
        CASE WHEN c3 >= 2 THEN 0 WHEN c2 >= 2 THEN (u IS NOT NULL)::INT ELSE (u IS NOT NULL)::INT + (v IS NOT NULL)::INT END AS b FROM e)
SELECT d.doc_id, count(l)::BIGINT AS n_words, round(sum(l) / nullif(count(l), 0), 4) AS mean_log10, coalesce(sum(b), 0)::BIGINT AS n_backoffs
FROM documents d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""
