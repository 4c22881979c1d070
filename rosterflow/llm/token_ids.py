"""Token ids of documents in Simple-8b blocks.

Ids are packed into 64-bit words: four bits select how many ids the word holds and of how
many bits each, as many ids as fit. An id of more than 60 bits is an escape: a word with
the escape selector, then the id as a word of its own. A block holds whole documents; its
head has the number of ids and words, the places of the escapes and the ids of each
document, so all words are decoded at once and every document is found by an offset.

Shards are Parquet files with one row per block, in the order of document ids: shard
numbers go with ranges of ids, and blocks of a shard are in order.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm import words
from rosterflow.llm.segments import SegmentCache
from rosterflow.session import fresh_dir

#: (ids in a word, bits of each) by selector, most ids first.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 14
#: A block is closed when it has so many ids.
BLOCK_IDS = 1 << 18
#: Texts are encoded in runs of so many bytes, and a process keeps so many segments.
RUN_BYTES, KEPT = 4_000_000, 1_500_000
#: Segments that are encoded as one text.
JOINED = 256
SHARD_CHARS = 16_000_000
END_ID = 0
BLOCKS = "shard int, block int, start long, n_ids long, doc_ids array<long>, payload binary"
_MAGIC = 0x31623853
_LIMITS = np.uint64(1) << np.array([b for _, b in SELECTORS], np.uint64)
#: The first selector that holds an id, of small ids.
_LEVELS = np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), "right").astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, places of escape words) of unsigned ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    level = np.full(n + 60, 0, np.uint8)  # an end short of ids is filled with zeros
    level[:n] = _LEVELS[ids] if ids.max() < len(_LEVELS) else np.searchsorted(_LIMITS, ids, "right")  # the first selector that holds the id; 14 for an escape
    choice = np.where(level[:n] == ESCAPE, ESCAPE, len(SELECTORS) - 1)
    for s in range(len(SELECTORS) - 2, int(level[:n].min()) - 1, -1):
        fits, width, count = level <= s, 1, SELECTORS[s][0]
        while width < count:  # whether so many ids from each place on are small enough
            more = min(width, count - width)
            fits, width = fits[: len(fits) - more] & fits[more:], width + more
        choice[fits[:n]] = s
    at = _chain(np.array([c for c, _ in SELECTORS] + [1])[choice])
    chosen = choice[at]
    where = np.arange(len(at)) + np.cumsum(chosen == ESCAPE) - (chosen == ESCAPE)
    out = np.zeros(len(at) + int((chosen == ESCAPE).sum()), np.uint64)
    padded = np.concatenate([ids, np.zeros(60, np.uint64)])
    for s in np.unique(chosen):
        own = chosen == s
        if s == ESCAPE:
            out[where[own]] = np.uint64(ESCAPE) << np.uint64(60)
            out[where[own] + 1] = ids[at[own]]
            continue
        count, bits = SELECTORS[s]
        begin = at[own]
        packed = np.full(len(begin), np.uint64(s) << np.uint64(60))
        for j in range(count):
            packed |= padded[begin + j] << np.uint64(j * bits)
        out[where[own]] = packed
    return out, where[chosen == ESCAPE]


def _chain(step: np.ndarray) -> np.ndarray:
    """The places 0, 0 + step[0], ... before the end; only each 64th is found one by one."""
    n = len(step)
    to = [np.append(np.minimum(np.arange(n) + step, n), n)]
    for _ in range(6):
        to.append(to[-1][to[-1]])
    far, at, i = to.pop(), [], 0
    while i < n:
        at.append(i)
        i = int(far[i])
    at = np.array(at)
    for hop in reversed(to):
        at = np.column_stack([at, hop[at]]).ravel()
    return at[at < n]


def unpack(packed: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids that ``pack`` got, all words at once."""
    kind = (packed >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in SELECTORS] + [1, 1])[kind]
    raw = np.zeros(len(packed), bool)
    raw[escapes + 1] = True
    counts[raw] = 0
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero((kind == s) & ~raw)
        if len(own):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            out[first[own][:, None] + np.arange(count)] = (packed[own][:, None] >> shifts) & np.uint64(2**bits - 1)
    out[first[escapes]] = packed[escapes + 1]
    return out[:n]


def to_block(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """A block of documents with ``sizes`` ids each."""
    packed, escapes = pack(ids)
    head = np.array([_MAGIC, len(sizes), len(ids), len(packed), len(escapes)], "<i8")
    return b"".join((head.tobytes(), sizes.astype("<i8").tobytes(), escapes.astype("<i8").tobytes(), packed.astype("<u8").tobytes()))


def from_block(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of a block."""
    magic, n_docs, n_ids, n_words, n_escapes = np.frombuffer(data, "<i8", 5).tolist()
    if magic != _MAGIC or len(data) != 8 * (5 + n_docs + n_escapes + n_words):
        raise ValueError("not a whole block")
    sizes = np.frombuffer(data, "<i8", n_docs, 40)
    escapes = np.frombuffer(data, "<i8", n_escapes, 40 + 8 * n_docs)
    return unpack(np.frombuffer(data, "<u8", n_words, 40 + 8 * (n_docs + n_escapes)), escapes, n_ids), sizes


#: Visible ASCII, which is no white space and ends any run of it; letters; signs but the apostrophe.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = _PLAIN & ~_LETTER
_SIGN[[*range(0x30, 0x3A), 0x27]] = False


def boundaries(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Starts of segments that a byte-level BPE with the usual word pattern encodes one by one.

    The pattern joins a space to what follows and takes white space in runs, whose last
    character it leaves to a following word. A run begins after a visible character; its
    last space, or a line end that is a run of its own, begins or ends a match. Letters
    and signs are matched apart (but for an apostrophe).
    """
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    starts = np.zeros(n + 1, bool)
    starts[at] = True
    plain = _PLAIN[raw]
    after_plain = np.zeros(n, bool)
    after_plain[1:] = plain[:-1]
    after_plain &= ~starts[:n]
    before_plain = np.zeros(n, bool)
    before_plain[:-1] = plain[1:]
    before_plain &= ~starts[1:]
    cut[:n] = (raw == 0x20) & (after_plain | before_plain)
    line = (raw == 0x0A) & after_plain
    cut[:n] |= line
    cut[1:] |= line & before_plain
    cut[1:n] |= _LETTER[raw[:-1]] & _SIGN[raw[1:]]
    cut[at[:-1]] = at[:-1] < at[1:]
    return np.flatnonzero(cut[:n])


_TOKENS: dict[str, Tokens] = {}


class Tokens:
    """Ids of texts by a tokenizer of the tokenizers library.

    The string of an added token is that token wherever it stands in a text, and what is
    around it is encoded apart. Without ``special``, those of special tokens are ordinary text.
    """

    def __init__(self, model: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(model)
        self._tokenizer.encode_special_tokens = not special
        added = [t for t in json.loads(model).get("added_tokens") or [] if t["content"] and (special or not t["special"])]
        # tokens that take in white space or ask for the characters around them: no segments, whole texts
        self._whole = any(t[flag] for t in added for flag in ("lstrip", "rstrip", "single_word", "normalized"))
        strings = sorted((t["content"].encode() for t in added), key=len, reverse=True)  # the longest goes first
        self._added = re.compile(b"|".join(map(re.escape, strings))) if strings else None
        vocabulary = self._tokenizer.get_vocab()
        # a character of a byte-level token stands for one byte
        self._lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self._lengths[list(vocabulary.values())] = list(map(len, vocabulary))
        self._cache = SegmentCache(self._new, KEPT)

    @classmethod
    def shared(cls, model: str) -> Tokens:
        """That of this process with special tokens, which keeps its encodings from task to task."""
        if model not in _TOKENS:
            _TOKENS.clear()
            _TOKENS[model] = cls(model, special=True)
        return _TOKENS[model]

    def _new(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of segments in a row, and how many each has.

        A segment that begins with a space and ends in visible ASCII is matched alike after
        another one (``boundaries``). Many such segments are one text, and the lengths of its
        tokens tell which ids are whose.
        """
        if self._whole:
            return self._apart(parts)
        joined = np.fromiter((p[0] == 0x20 and _PLAIN[p[-1]] for p in parts), bool, len(parts))
        along, where = list(compress(parts, joined)), np.flatnonzero(joined)
        sizes, found = np.zeros(len(parts), np.int64), []
        for i in range(0, len(along), JOINED):
            ids, size = self._in_one(along[i : i + JOINED])
            found.append(ids)
            sizes[where[i : i + JOINED]] = size
        others, sizes[~joined] = self._apart(list(compress(parts, ~joined)))
        if not found:
            return others, sizes
        out, mine = np.empty(int(sizes.sum()), np.int32), np.repeat(joined, sizes)
        out[mine], out[~mine] = np.concatenate(found), others
        return out, sizes

    def _in_one(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        text = b"".join(parts)
        if self._added and self._added.search(text):
            return self._apart(parts)
        found = self._tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)
        ids = np.array(found[0].ids, np.int32)
        reach = np.cumsum(self._lengths[ids])
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        last = np.searchsorted(reach, ends)
        if not len(reach) or reach[-1] != ends[-1] or (reach[last] != ends).any():
            return self._apart(parts)  # not a token a run of bytes
        return ids, np.diff(last, prepend=-1)

    def _apart(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for i in range(0, len(parts), 20_000):
            found = self._tokenizer.encode_batch_fast([p.decode() for p in parts[i : i + 20_000]], add_special_tokens=False)
            out.extend(f.ids for f in found)
        sizes = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int32, int(sizes.sum())), sizes

    def _segments(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Starts of segments that are encoded one by one; an added token is one."""
        if self._whole:
            return at[:-1][at[:-1] < at[1:]]
        data = raw.tobytes()
        if not self._added or not self._added.search(data):
            return boundaries(raw, at)
        spans = [m.span() for i, j in zip(at[:-1].tolist(), at[1:].tolist()) for m in self._added.finditer(data, i, j)]
        first, end = np.array(spans, np.int64).reshape(-1, 2).T
        start = boundaries(raw, np.unique(np.concatenate([at, first, end])))
        token = np.searchsorted(first, start, "left") - 1  # the last one that begins before
        inside = (token >= 0) & (start < np.append(end, 0)[token])
        return start[~inside]

    def __call__(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the offsets between them."""
        start = self._segments(raw, at)
        ids, total = self._cache(raw, start, np.append(start[1:], len(raw)))
        return ids, total[np.searchsorted(start, at)]


def write_token_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_chars: int = SHARD_CHARS) -> None:
    """Encode ``docs (doc_id, text)`` with the tokenizer file ``tokenizer`` and write blocks to ``path``.

    Each document ends with ``end_id``; a null or empty text is that id alone. Documents
    are in order of ``doc_id`` (null first), rows with one id in order of their text. An
    empty table writes no blocks. Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:  # a public vocabulary of some MB, beside the driver
        model = spark.sparkContext.broadcast(f.read())
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // shard_chars))
    tie = F.xxhash64("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard = Tokens.shared(model.value), TaskContext.get().partitionId()
        block, start, ids, sizes, doc_ids = 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            nonlocal block, start, ids, sizes, doc_ids
            whole = np.concatenate(ids)
            row = [[shard], [block], [start], [len(whole)], [doc_ids], [to_block(whole, np.array(sizes))]]
            block, start, ids, sizes, doc_ids = block + 1, start + len(whole), [], [], []
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], ["shard", "block", "start", "n_ids", "doc_ids", "payload"])

        for batch in batches:
            raw, at = words.utf8(batch["text"])
            for i, j in words.runs(at, RUN_BYTES):
                found, first = tokens(raw[at[i] : at[j]], at[i : j + 1] - at[i])
                own = np.insert(found, first[1:], end_id)
                lengths = np.diff(first) + 1
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                names = batch["doc_id"].slice(i, j - i).to_pylist()
                k = 0
                while k < j - i:  # whole documents up to the block's size
                    room = BLOCK_IDS - sum(map(len, ids))
                    m = min(j - i, max(k + 1, int(np.searchsorted(cuts, cuts[k] + room, "left"))))
                    ids.append(own[cuts[k] : cuts[m]])
                    sizes.extend(lengths[k:m].tolist())
                    doc_ids.extend(names[k:m])
                    k = m
                    if sum(map(len, ids)) >= BLOCK_IDS:
                        yield close()
        if sizes:
            yield close()

    ranged = docs.withColumn("tie", tie).repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    ranged.select("doc_id", "text").mapInArrow(run, BLOCKS).write.parquet(path)


def read_token_shards(spark, path: str) -> DataFrame:
    """The blocks at ``path``; ``documents_of`` decodes them."""
    return spark.read.schema(BLOCKS).parquet(path)


def documents_of(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document of all blocks, from the decoded ids.

    ``start`` is the number of ids of all documents before it. Sums of shards, one small
    row each, give the place where a shard begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, doc_ids, payload in zip(*(batch[c].to_pylist() for c in ("shard", "start", "doc_ids", "payload"))):
                ids, sizes = from_block(payload)
                ends = np.cumsum(sizes)
                data = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sizes), shard, np.int32)), pa.array(doc_ids, pa.int64()), pa.array(start + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    begins = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("begin"))
    found = blocks.select("shard", "start", "doc_ids", "payload").mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(begins, "shard").select("doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def op7_simple8b(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_dir(spark, "token-shards")
    write_token_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return documents_of(read_token_shards(spark, path))
