"""Which documents hold windows of benchmark items.

A prefix-filtered set join for containment. An item's *windows* are its runs of 13 words
(an item of fewer words is one window). A document that contains a window contains all its
shingles, so the necessary prefix of a window, with its shingles ordered by rarity in the
documents, is a single one: the rarest. Documents join on that shingle alone; the place of
the shingle gives the place where the window can lie, which must be inside the text
(positional and length bounds). Equal windows are one *kind*, whatever items hold them, and a
place of a text is looked up among the kinds by one hash, then compared byte by byte: the
work follows the places where rare shingles occur, not the pairs of places and windows.

Items are worked on in blocks of a bounded number of words, so what a task holds does not
grow with the benchmark; each block is one pass over the documents to count its shingles
and one to join them. An item is cut into segments first, so a huge item has many blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import words, work

WINDOW = 13
SHINGLE = 3
#: Words of items in one block, about 60 bytes each in a task.
BLOCK_WORDS = 1_000_000
SEGMENT_WINDOWS = 4096
#: A document is contaminated if one word in so many is hit.
ONE_IN = 20

SPANS = "doc_id long, text_key long, copies long, n_words long, begins array<long>, ends array<long>, items array<string>"

TOTALS = "doc_id long, text_key long, n_words long, n_hit long, begins array<long>, ends array<long>, items array<string>, items_sha256 string"


def _words(texts) -> words.Words:
    raw, at = words.utf8(texts)
    return words.split(words.folded(raw), at, words.ALPHANUMERIC)


def segments(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, size, text``: pieces of each item's words, overlapping so that each window is in one; ``size``: its windows' length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            found = _words(batch["text"])
            for k, item in enumerate(batch["item"].to_pylist()):
                lo, hi = int(found.first[k]), int(found.first[k + 1])
                size = min(window, hi - lo)
                for at in range(lo, hi - size + 1, SEGMENT_WINDOWS) if size else ():
                    end = min(at + SEGMENT_WINDOWS + size - 1, hi)
                    out.append((item, size, b" ".join(found.raw[found.start[p] : found.end[p]].tobytes() for p in range(at, end)).decode()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.string(), pa.int32(), pa.string()))], ["item", "size", "text"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return named.mapInArrow(run, "item string, size int, text string").distinct()


def _same_words(a: words.Words, at: np.ndarray, b: words.Words, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` words of ``a`` from each ``at`` on are those of ``b`` from ``place`` on, byte by byte."""
    same = np.ones(len(at), bool)
    for i in range(0, len(at), 20_000):
        n = size[i : i + 20_000]
        window = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
        x, y = at[i : i + 20_000][window] + j, place[i : i + 20_000][window] + j
        length = a.end[x] - a.start[x]
        equal = length == b.end[y] - b.start[y]
        x, y, length, left = x[equal], y[equal], length[equal], np.flatnonzero(equal)
        char = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        other = a.raw[np.repeat(a.start[x], length) + char] != b.raw[np.repeat(b.start[y], length) + char]
        equal[left[np.repeat(np.arange(len(left)), length)[other]]] = False
        same[i + window[~equal]] = False
    return same


def _hash_at(hashes: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """``words.ngrams`` of ``n`` words at some places only."""
    out = np.zeros(len(begins), np.uint64)
    for j, m in enumerate(words.powers(n + 1)[1:]):
        out += hashes[begins + j] * m
    return words.mix(out + np.uint64(n))


@dataclass
class Windows:
    """The distinct windows of one block of items, by size and hash; equal ones are one *kind*."""

    items: list[str]  # of each segment
    found: words.Words
    hashes: np.ndarray
    start: np.ndarray  # of each kind: its first word, size and hash
    size: np.ndarray
    full: np.ndarray
    first: np.ndarray  # of each kind: the place of its first segment in ``segment``
    segment: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> Windows:
        found = _words(rows["text"])
        hashes, sizes = found.hashes(), rows["size"].to_numpy().astype(np.int64)
        n = np.diff(found.first) - sizes + 1
        segment = np.repeat(np.arange(len(sizes)), n)
        start = found.first[segment] + np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
        size = sizes[segment]
        full = np.zeros(len(start), np.uint64)
        for s in np.unique(size):
            full[size == s] = _hash_at(hashes, start[size == s], int(s))
        order = np.lexsort((start, full, size))
        start, size, full, segment = start[order], size[order], full[order], segment[order]
        new = np.ones(len(start), bool)
        new[1:] = (size[1:] != size[:-1]) | (full[1:] != full[:-1])
        leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        new |= ~_same_words(found, start, found, start[leader], size)  # a hash that two texts share
        first = np.flatnonzero(new)
        return cls(rows["item"].to_pylist(), found, hashes, start[first], size[first], full[first], np.append(first, len(start)), segment)

    def shingles(self, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, kinds, their shingles as rows) for each length of shingle."""
        for s in range(1, width + 1):
            own = np.flatnonzero(self.size >= width if s == width else self.size == s)
            grams = words.ngrams(self.hashes, s)
            for size in np.unique(self.size[own]):
                some = own[self.size[own] == size]
                yield s, some, grams[self.start[some][:, None] + np.arange(size - s + 1)]

    def at(self, hashes: np.ndarray, begins: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(kind, place) of each window of a text that has the hash of a kind; each is looked at once."""
        kinds, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s in np.unique(size):
            own = np.unique(begins[size == s])
            value = _hash_at(hashes, own, int(s))
            low, high = np.searchsorted(self.size, [s, s + 1])
            left, right = (low + np.searchsorted(self.full[low:high], value, side) for side in ("left", "right"))
            for k in range(int((right - left).max(initial=0))):
                hit = left + k < right
                kinds.append((left + k)[hit])
                places.append(own[hit])
        return np.concatenate(kinds), np.concatenate(places)

    def items_of(self, kinds: np.ndarray) -> list[str]:
        """The items that hold any of the kinds, sorted."""
        own = [self.segment[self.first[k] : self.first[k + 1]] for k in np.unique(kinds)]
        return sorted({self.items[s] for s in np.unique(np.concatenate([np.empty(0, np.int64), *own]))})


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, words.Words]]:
    for batch in batches:
        raw, at = words.utf8(batch["text"])
        for i, j in words.runs(at):
            yield batch.slice(i, j - i), words.split(words.folded(raw[at[i] : at[j]]), at[i : j + 1] - at[i], words.ALPHANUMERIC)


def _rarity(spark: SparkSession, docs: DataFrame, keys: np.ndarray, lengths: list[int]) -> np.ndarray:
    """How often each shingle of a block occurs in all documents."""
    shared = spark.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = words.Lookup(shared.value)
        counts = np.zeros(len(find.keys), np.int64)
        for _, found in _texts(batches):
            hashes = found.hashes()
            for s in lengths:
                _, at = find(words.ngrams(hashes, s)[words.within(found.text, s)])
                counts += np.bincount(at, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["key", "n"])

    told = docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(keys), np.int64)
    out[told["key"].to_numpy(np.int64)] = told["n"].to_numpy(np.int64)
    return out


def _prefixes(windows: Windows, width: int, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rarest shingles of all kinds, each with the places where it stands in kinds and their sizes: (shingles, places, sizes)."""
    best, place = np.empty(len(windows.start), np.uint64), np.empty(len(windows.start), np.int64)
    for _, some, grams in windows.shingles(width):
        at = np.searchsorted(keys, grams)
        column = np.argmin(counts[at] * len(keys) + at if len(keys) < 2**31 else counts[at], axis=1)
        best[some], place[some] = grams[np.arange(len(some)), column], column
    order = np.lexsort((windows.size, place, best))
    best, place, size = best[order], place[order], windows.size[order]
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (place[1:] != place[:-1]) | (size[1:] != size[:-1])
    return best[new], place[new], size[new]


def _join(spark: SparkSession, docs: DataFrame, windows: Windows, prefixes, lengths: list[int], first: bool, alone: bool) -> DataFrame:
    """Spans of each document's hit words, and the items they belong to; after the ``first`` block only of documents with hits.

    A block that is ``alone`` gives the totals at once.
    """
    shared = spark.sparkContext.broadcast((windows, prefixes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win, (keys, place, size) = shared.value
        uniq, begin = np.unique(keys, return_index=True)
        count = np.diff(begin, append=len(keys))
        find = words.Lookup(uniq)
        for batch, found in _texts(batches):
            hashes = found.hashes()
            at, key = [], []
            for s in lengths:
                starts = np.flatnonzero(words.within(found.text, s))
                which, k = find(words.ngrams(hashes, s)[starts])
                at.append(starts[which])
                key.append(k)
            at, key = np.concatenate(at), np.concatenate(key)
            kinds, begins = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i in range(0, len(at), 50_000):  # a prefix stands at no more places than a window has words
                a, k = at[i : i + 50_000], key[i : i + 50_000]
                n = count[k]
                entry = np.repeat(begin[k], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                b, text = np.repeat(a, n) - place[entry], np.repeat(found.text[a], n)
                fits = (b >= found.first[text]) & (b + size[entry] <= found.first[text + 1])
                kind, b = win.at(hashes, b[fits], size[entry][fits])
                exact = _same_words(found, b, win.found, win.start[kind], win.size[kind])
                kinds.append(kind[exact])
                begins.append(b[exact])
            yield from _spans(batch, found, win, np.concatenate(kinds), np.concatenate(begins), first)
        work.release()

    keyed = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    if alone:  # in the same worker
        return keyed.mapInArrow(lambda batches: _totals(run(batches)), TOTALS)
    return keyed.mapInArrow(run, SPANS)


def _spans(batch, found: words.Words, win: Windows, kinds: np.ndarray, begins: np.ndarray, first: bool) -> Iterator[pa.RecordBatch]:
    order = np.argsort(begins, kind="stable")
    kinds, begins = kinds[order], begins[order]
    cut = np.searchsorted(begins, found.first)
    columns: dict[str, list] = {name: [] for name in ("at", "begins", "ends", "items")}
    for k in range(batch.num_rows) if first else np.flatnonzero(np.diff(cut)):
        own = kinds[cut[k] : cut[k + 1]]
        b = begins[cut[k] : cut[k + 1]] - found.first[k]
        b, e = merged(b, b + win.size[own])
        columns["at"].append(k)
        columns["begins"].append(b)
        columns["ends"].append(e)
        columns["items"].append(win.items_of(own))
    rows = batch.take(pa.array(columns["at"], pa.int64()))
    n_words = np.diff(found.first)[np.array(columns["at"], np.int64)]
    yield pa.RecordBatch.from_arrays(
        [rows["doc_id"], rows["text_key"], pa.array(np.full(rows.num_rows, int(first))), pa.array(n_words, pa.int64()), pa.array(columns["begins"], pa.list_(pa.int64())), pa.array(columns["ends"], pa.list_(pa.int64())), pa.array(columns["items"], pa.list_(pa.string()))],
        ["doc_id", "text_key", "copies", "n_words", "begins", "ends", "items"],
    )


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges as few disjoint ones; ``begins`` ascend."""
    if not len(begins):
        return begins, ends
    far = np.maximum.accumulate(ends)
    new = np.concatenate([[True], begins[1:] > far[:-1]])
    return begins[new], far[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(far) - 1]])]


def find_contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, begins, ends, items`` of each row of ``docs (doc_id, text)``.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased.
    ``begins`` and ``ends`` are ranges of hit words, ``items`` the ids (as text, sorted)
    of ``items (item_id, text)`` with a window in the document. A null or empty text has
    no words and no hits; an item without words has no windows; an item without an id is
    listed as ``''``; items that share an id are one. Repeated rows are judged each.
    Other columns are ignored. No items, or no documents, give no hits or no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    cut = work.written(segments(items, window), "benchmark-segments")
    total = cut.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    parts = []
    for k in range(n):
        some = cut.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k) if n > 1 else cut
        windows = Windows.of(some.orderBy("item", "text").toArrow())
        lengths = sorted({s for s, *_ in windows.shingles(shingle)})
        keys = np.unique(np.concatenate([np.empty(0, np.uint64), *(g.ravel() for *_, g in windows.shingles(shingle))]))
        counts = _rarity(spark, docs, keys, lengths) if len(keys) else np.empty(0, np.int64)
        parts.append(_join(spark, docs, windows, _prefixes(windows, shingle, keys, counts), lengths or [1], not k, n == 1))
    out = parts[0]
    if n > 1:
        for more in parts[1:]:
            out = out.unionByName(more)
        flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
        out = out.groupBy("doc_id", "text_key", "n_words").agg(F.sum("copies").alias("copies"), flat("begins"), flat("ends"), flat("items"))
        out = out.withColumn("copies", F.explode(F.expr("array_repeat(1L, cast(copies as int))")))
    return out if n == 1 else out.mapInArrow(_totals, TOTALS)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_key", "n_words", "n_hit", "begins", "ends", "items", "items_sha256"]
    for batch in batches:
        hit, begins, ends, items = [], [], [], []
        for b, e, i in zip(batch["begins"].to_pylist(), batch["ends"].to_pylist(), batch["items"].to_pylist()):
            order = np.argsort(b, kind="stable")
            b, e = merged(np.array(b, np.int64)[order], np.array(e, np.int64)[order])
            hit.append(int((e - b).sum()))
            begins.append(b)
            ends.append(e)
            items.append(sorted(set(i)))
        digest = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["text_key"], batch["n_words"], pa.array(hit, pa.int64()), *(pa.array(c, pa.list_(pa.int64())) for c in (begins, ends)), pa.array(items, pa.list_(pa.string())), pa.array(digest, pa.string())], names
        )


def contaminated(one_in: int = ONE_IN):
    return (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))


def op9_benchmark_windows(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", contaminated().alias("contaminated"))


SQL = rf"""
WITH low AS (SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
it AS (SELECT item_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS p FROM it WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM low, ks)),
hit AS (SELECT doc_id, k, p, item_id FROM dw JOIN iw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND {ONE_IN} * coalesce(h.n, 0) >= len(w) AS contaminated
FROM low LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""
