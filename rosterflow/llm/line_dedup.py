"""Lines that several documents share, kept in the first of them only.

Two Bloom filters find suspects: one of the line hashes seen once, one of those seen again.
The hash space is cut into *segments*. Each task sends a segment the packed hashes of its
documents' lines (some five bytes a line, one hash of a document's equal lines); a segment's
task puts each into its first filter, and into its second when the first holds it already.
The second filters are small, as only repeated lines are in them, and together are no larger
than ``max_bits``: this is the one thing that is broadcast. Beyond that bound they are
narrower a line, so more lines are suspects and results stay the same.

Only suspects are then shuffled, as exact text: the least document of a line comes from an
aggregate that is combined before its shuffle, so a line in a third of all documents is one
row a task, and the join back is one that Spark can split. Documents without a suspect never
move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import words, work

#: Shorter lines (code points of the key) stay wherever they are.
MIN_CHARS = 10
#: Lines that a segment of the hash space has on average, at most.
SEGMENT_LINES = 1 << 18
#: Bits a line of the filter of lines seen once, and of the one of lines seen again.
ONCE_BITS, AGAIN_BITS = 16, 4
#: Bits of all filters of lines seen again: 32 MB.
MAX_BITS = 1 << 28
#: Lines whose hashes a task holds before it sends them.
CHUNK_LINES = 2_000_000
PROBES = 4

_UPPER, _LOWER, _BLANK = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", " \t\n\x0b\f\r"
_NEW_CHAR = np.ones(256, np.int64)
_NEW_CHAR[0x80:0xC0] = 0  # bytes inside a character


@dataclass(frozen=True)
class Filters:
    """How the hash space is cut, and how many bits a segment's filters have; all are powers of two."""

    segments: int
    once: int
    again: int

    @classmethod
    def of(cls, lines: int, segment_lines: int = SEGMENT_LINES, max_bits: int = MAX_BITS) -> Filters:
        segments = min(1 << ((max(lines, 1) - 1) // segment_lines).bit_length(), max(1, max_bits // 8))
        return cls(segments, segment_lines * ONCE_BITS, max(8, min(segment_lines * AGAIN_BITS, max_bits // segments)))

    def segment(self, hashes: np.ndarray) -> np.ndarray:
        bits = self.segments.bit_length() - 1
        return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of a filter that stand for each hash."""
    other = words.mix(hashes)
    step = (other >> np.uint64(32)) | np.uint64(1)
    for _ in range(PROBES):
        yield (other & np.uint64(bits - 1)).astype(np.int64)
        other = other + step


class Bloom:
    """A Bloom filter of hashes, one byte a bit while it is filled."""

    def __init__(self, bits: int):
        self.bits = np.zeros(bits, bool)

    def add(self, hashes: np.ndarray) -> None:
        for at in probes(hashes, len(self.bits)):
            self.bits[at] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in probes(hashes, len(self.bits)):
            out &= self.bits[at]
        return out


@dataclass(frozen=True)
class Again:
    """The filters of lines seen again, of all segments in a row."""

    filters: Filters
    packed: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        base = self.filters.segment(hashes) * self.filters.again
        out = np.ones(len(hashes), bool)
        for at in probes(hashes, self.filters.again):
            at += base
            out &= (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


@dataclass
class Lines:
    """The lines of several texts, and the keys in them as byte ranges of ``raw``."""

    raw: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    chars: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, at: np.ndarray) -> Lines:
        """Texts are cut at every line end; an empty text is one empty line."""
        raw = words.folded(raw)
        breaks = np.flatnonzero(raw == 0x0A)
        # the text of a line end is the last that begins at or before it
        text = np.sort(np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, breaks, "right") - 1]), kind="stable")
        first = np.ones(len(text), bool)
        first[1:] = text[1:] != text[:-1]
        last = np.ones(len(text), bool)
        last[:-1] = first[1:]
        start, end = np.empty(len(text), np.int64), np.empty(len(text), np.int64)
        start[first], end[last] = at[:-1], at[1:]
        start[~first], end[~last] = breaks + 1, breaks
        inked = np.flatnonzero(words.NOT_SPACE[raw])
        low, high = np.searchsorted(inked, start), np.searchsorted(inked, end)
        full = low < high
        start[full], end[full] = inked[low[full]], inked[high[full] - 1] + 1
        end[~full] = start[~full]
        chars = np.concatenate([[0], np.cumsum(_NEW_CHAR[raw])])
        return cls(raw, text, start, end, chars[end] - chars[start])

    def hashes(self, which: np.ndarray) -> np.ndarray:
        return words.range_hashes(self.raw, self.start[which], self.end[which])


def _lines(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[pa.RecordBatch, Lines, np.ndarray, np.ndarray]]:
    """Runs of texts with their lines, those of ``least`` code points, and their hashes."""
    for batch in batches:
        raw, at = words.utf8(batch["text"])
        for i, j in words.runs(at):
            lines = Lines.of(raw[at[i] : at[j]], at[i : j + 1] - at[i])
            long = np.flatnonzero(lines.chars >= least)
            yield batch.slice(i, j - i), lines, long, lines.hashes(long)


def _pack(hashes: np.ndarray) -> tuple[int, bytes]:
    gaps = np.diff(hashes, prepend=np.uint64(0))
    # the first gap holds the segment's place and is as wide as a hash; it is kept apart
    width = max(1, (int(gaps[1:].max()).bit_length() + 7) // 8) if len(gaps) > 1 else 1
    return width, gaps[:1].astype("<u8").tobytes() + gaps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(width: int, packed: bytes) -> np.ndarray:
    rest = np.frombuffer(packed, np.uint8, offset=8).reshape(-1, width) if len(packed) > 8 else np.empty((0, 1), np.uint8)
    wide = np.zeros((len(rest) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(packed, np.uint8, 8)
    wide[1:, : rest.shape[1]] = rest
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def seen_again(docs: DataFrame, filters: Filters, least: int = MIN_CHARS) -> Again:
    """The second filters: they hold the hash of every line that two rows of ``docs`` have, and few others."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = []
            for again in (False, True):
                some = hashes[(counts > 1) == again]
                segment = filters.segment(some)
                cut = np.flatnonzero(np.diff(segment, prepend=-1))
                rows += [(int(segment[i]), again, *_pack(some[i:j])) for i, j in zip(cut, [*cut[1:], len(some)])]
            columns = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.bool_(), pa.int32(), pa.binary()))], ["segment", "again", "width", "packed"])

        for _, lines, long, hashes in _lines(batches, least):
            order = np.lexsort((hashes, lines.text[long]))
            text, hashes = lines.text[long][order], hashes[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
            held.append(hashes[new])
            size += int(new.sum())
            if size >= CHUNK_LINES:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    def fill(table: pa.Table) -> pa.Table:
        once, again = Bloom(filters.once), Bloom(filters.again)
        for repeated, width, packed in zip(table["again"].to_pylist(), table["width"].to_pylist(), table["packed"].to_pylist()):
            hashes = _unpack(width, packed)
            again.add(hashes if repeated else hashes[once.holds(hashes)])
            once.add(hashes)
        return pa.table({"segment": table["segment"][:1], "packed": pa.array([np.packbits(again.bits, bitorder="little").tobytes()], pa.binary())})

    sent = docs.select("text").mapInArrow(send, "segment int, again boolean, width int, packed binary")
    filled = sent.groupBy("segment").applyInArrow(fill, "segment int, packed binary").toArrow()
    whole = np.zeros((filters.segments, filters.again // 8), np.uint8)
    for segment, packed in zip(filled["segment"].to_pylist(), filled["packed"].to_pylist()):
        whole[segment] = np.frombuffer(packed, np.uint8)
    return Again(filters, whole.ravel())


def suspects(docs: DataFrame, again: Again, least: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text, n_lines, suspect``: whether each line may be in another row too; null if none may."""
    shared = docs.sparkSession.sparkContext.broadcast(again)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lines, long, hashes in _lines(batches, least):
            flag = np.zeros(len(lines.text), bool)
            flag[long] = shared.value.holds(hashes)
            n = np.bincount(lines.text, minlength=batch.num_rows)
            some = np.bincount(lines.text[flag], minlength=batch.num_rows) > 0
            kept = flag[some[lines.text]]
            offsets = np.concatenate([[0], np.cumsum(np.where(some, n, 0))])
            flags = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(kept, pa.bool_()), mask=pa.array(~some))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"], pa.array(n, pa.int64()), flags], ["doc_id", "text", "n_lines", "suspect"])

    return docs.mapInArrow(run, "doc_id long, text string, n_lines long, suspect array<boolean>")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines at the places ``gone``."""
    for batch in batches:
        texts, dropped = [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist()):
            lines = text.split("\n")
            out = set(gone or ())
            texts.append("\n".join(line for k, line in enumerate(lines) if k not in out))
            dropped.append(len(out))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string()), batch["n_lines"], pa.array(dropped, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])


def drop_repeated_lines(docs: DataFrame, least: int = MIN_CHARS, segment_lines: int = SEGMENT_LINES, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of each row of ``docs (doc_id, text)``: texts without lines of earlier documents.

    A text is cut at every ``\\n``. A line's key is the line without blanks
    (`[\\x20\\x09-\\x0D]`) at its ends, with A-Z lower-cased. Keys of at least ``least`` code
    points in two documents or more lose all their lines but those of the document of the
    smallest ``doc_id``, which keeps each. ``n_lines`` counts the lines before that.

    A null or empty text is one empty line and comes out as ``''``; so does a text that
    loses all lines. Rows of one ``doc_id`` are one document: what only they share stays in
    each. Rows without an id are one document behind all others. Texts of any length are
    read whole; a line may be a whole long text. Other columns are ignored, whatever their
    names. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    total = docs.agg(F.sum(breaks + 1)).first()[0] or 0
    again = seen_again(docs, Filters.of(total, segment_lines, max_bits), least)
    looked = work.written(suspects(docs, again, least).withColumn("row", F.monotonically_increasing_id()), "suspected-lines")

    some = looked.where("suspect is not null")
    zipped = some.select("row", "doc_id", F.posexplode(F.arrays_zip(F.split("text", "\n").alias("line"), F.col("suspect").alias("suspect"))).alias("place", "cell"))
    key = F.translate(F.btrim("cell.line", F.lit(_BLANK)), _UPPER, _LOWER)
    lines = zipped.where("cell.suspect").select("row", "doc_id", "place", key.alias("key"))
    first = lines.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("nameless"))
    shared = first.where("first < last or (first is not null and nameless)").select("key", "first")
    gone = lines.join(shared, "key").where("doc_id is null or doc_id > first").groupBy("row").agg(F.collect_list("place").alias("gone"))

    whole = looked.where("suspect is null").select("doc_id", "text", "n_lines", F.lit(0).cast("long").alias("n_dropped"))
    cut = some.select("row", "doc_id", "text", "n_lines").join(gone, "row", "left").drop("row")
    return whole.unionByName(cut.mapInArrow(_without, "doc_id long, text string, n_lines long, n_dropped long"))


def op13_line_blooms(spark, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key FROM l),
shared AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT doc_id, k, line, first IS NOT NULL AND doc_id > first AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
