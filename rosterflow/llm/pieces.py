"""SentencePiece encoding and decoding with a unigram model.

An encoding is the segmentation of a text into pieces with the greatest sum of log scores.
The text gets a marker in front, and spaces become markers. Pieces lie in a double-array
trie over bytes; the marker is the byte 0xFF there, which no UTF-8 text holds, so a literal
U+2581 in a text is no marker and every text is restored exactly. A character that no
piece covers alone may be passed at an unknown's score and is written as byte pieces.

No piece goes on past the place before a marker (checked on loading), so the best
segmentation of a text is that of its marker-led segments one by one. Each task keeps the
encodings of a bounded number of distinct segments; new ones are segmented together, in
numpy, a byte place at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import words, work
from rosterflow.llm.segments import SegmentCache

MARKER = 0xFF
_SIGN = "▁"
#: How much an unknown character scores below the least piece.
UNKNOWN_PENALTY = 10.0
#: Segments longer than this are segmented one at a time.
WIDE = 96
#: Segments that are segmented together.
LANES = 2048
RUN_BYTES = 250_000
#: Distinct segments whose encodings a task keeps.
KEPT = 120_000
_UNKNOWN_TEXT = " ⁇ ".encode()


class DoubleArray:
    """A trie in two arrays: the child of ``s`` by byte ``b`` is ``t = base[s] + b + 1`` if ``check[t] == s``."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for k, key in enumerate(keys):
            node = 0
            for b in key:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                node = children[node][b]
            ends[node] = k
        size = 4 * len(children) + 1024
        base, check, value = [0] * size, [-1] * size, [-1] * size
        check[0] = 0
        place, queue = {0: 0}, [0]
        hole, room = 1, 1  # where to look for one free slot, and for several
        for node in queue:
            at = place[node]
            value[at] = ends.get(node, -1)
            below = sorted(children[node])
            if not below:
                base[at] = size  # leads nowhere
                continue
            slot, tries = (hole, 0) if len(below) == 1 else (room, 0)
            while slot <= below[0] or check[slot] != -1 or any(check[slot - below[0] + c] != -1 for c in below[1:]):
                slot += 1
                tries += 1
                if slot + 257 >= len(check):
                    for array, empty in ((base, 0), (check, -1), (value, -1)):
                        array.extend([empty] * size)
            if len(below) == 1:
                hole = slot if below[0] == 0 or slot > 257 else hole
            elif tries > 64:
                room = slot  # too crowded before it
            base[at] = slot - below[0] - 1
            for c in below:
                check[slot - below[0] + c] = at
                place[children[node][c]] = slot - below[0] + c
                queue.append(children[node][c])
        used = max(place.values()) + 258
        self.base = np.minimum(np.array(base[:used]), used - 257).astype(np.int32)
        self.check = np.array(check[:used], np.int32)
        self.check[used - 257 :] = -1
        self.check[0] = -1
        self.value = np.array(value[:used], np.int32)


@dataclass
class Model:
    """Pieces by id: their bytes, log scores and kinds."""

    surface: list[bytes]
    score: np.ndarray
    normal: np.ndarray  # ids of pieces that a segmentation may use
    byte_id: np.ndarray  # by byte
    unknown: float
    trie: DoubleArray = field(repr=False)

    @classmethod
    def load(cls, path: str) -> Model:
        """The model in a SentencePiece file, which is opened where this is called.

        Scores of a BPE file are ranks of merges, not log scores; there a piece of rank
        ``r`` scores ``-log(1 + r)``, as in a vocabulary that follows Zipf's law.
        """
        from sentencepiece import sentencepiece_model_pb2 as proto

        file = proto.ModelProto()
        with open(path, "rb") as f:
            file.ParseFromString(f.read())
        score = np.array([p.score for p in file.pieces], np.float64)
        if file.trainer_spec.model_type == proto.TrainerSpec.BPE:
            score = -np.log1p(np.minimum(-score, len(score)))
        kind = np.array([p.type for p in file.pieces])
        return cls.of([p.piece for p in file.pieces], score, kind == 1, kind == 6)

    @classmethod
    def of(cls, pieces: list[str], score: np.ndarray, is_normal: np.ndarray, is_byte: np.ndarray) -> Model:
        surface = [b""] * len(pieces)
        byte_id = np.zeros(256, np.int32)
        for k, p in enumerate(pieces):
            if is_byte[k]:
                byte_id[int(p[3:5], 16)] = k
                surface[k] = bytes([int(p[3:5], 16)])
            elif is_normal[k]:
                surface[k] = p.encode().replace(_SIGN.encode(), bytes([MARKER]))
                if bytes([MARKER]) in surface[k].lstrip(bytes([MARKER])):
                    raise ValueError(f"piece {p!r} goes on past a marker")
        if is_byte.sum() != 256:
            raise ValueError("the model has no byte fallback")
        normal = np.flatnonzero(is_normal)
        return cls(surface, score, normal, byte_id, float(score[normal].min() - UNKNOWN_PENALTY), DoubleArray([surface[k] for k in normal]))

    def segment(self, parts: list[bytes]) -> list[np.ndarray]:
        """The ids of each part."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(parts)
        sizes = np.array([len(p) for p in parts])
        order = np.argsort(sizes, kind="stable")
        short = order[sizes[order] <= WIDE]
        for i in range(0, len(short), LANES):
            some = short[i : i + LANES]
            for k, ids in zip(some, self._together([parts[k] for k in some], sizes[some])):
                out[k] = ids
        for k in order[len(short) :]:
            out[k] = self._alone(parts[k])
        return out

    def _alone(self, part: bytes) -> np.ndarray:
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        best, back = [0.0] + [-np.inf] * len(part), [(0, -1)] * (len(part) + 1)
        for i in range(len(part)):
            if 0x80 <= part[i] < 0xC0:
                continue
            size = 1
            while i + size < len(part) and 0x80 <= part[i + size] < 0xC0:
                size += 1
            at, alone = 0, False
            for j in range(i, len(part)):
                to = int(base[at]) + part[j] + 1
                if check[to] != at:
                    break
                at = to
                if (k := int(value[at])) >= 0:
                    alone |= j + 1 == i + size
                    if (s := best[i] + self.score[self.normal[k]]) > best[j + 1]:
                        best[j + 1], back[j + 1] = s, (i, int(self.normal[k]))
            if not alone and best[i] + self.unknown > best[i + size]:
                best[i + size], back[i + size] = best[i] + self.unknown, (i, -1)
        ids: list[int] = []
        j = len(part)
        while j:
            i, k = back[j]
            ids.extend([k] if k >= 0 else [int(self.byte_id[b]) for b in reversed(part[i:j])])
            j = i
        return np.array(ids[::-1], np.int32)

    def _together(self, parts: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
        """As ``_alone``, for parts of rising sizes."""
        n, wide = len(parts), int(sizes[-1])
        text = np.zeros((wide + 1, n), np.int32)
        for k, p in enumerate(parts):
            text[: len(p), k] = np.frombuffer(p, np.uint8)
        text[wide] = 0x80
        begins = (text < 0x80) | (text >= 0xC0)
        begins[np.arange(wide + 1)[:, None] >= sizes] = True
        after = np.full((wide + 1, n), wide + 1, np.int32)  # the next place where a character begins
        for i in range(wide - 1, -1, -1):
            after[i] = np.where(begins[i + 1] | (i + 1 >= sizes), i + 1, after[i + 1])
        best = np.full((wide + 1, n), -np.inf)
        best[0] = 0
        source, piece = np.zeros((wide + 1, n), np.int32), np.full((wide + 1, n), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        score = self.score[self.normal]
        for i in range(wide):
            lanes = np.flatnonzero(begins[i] & (sizes > i))
            if not len(lanes):
                continue
            alone = np.zeros(n, bool)
            at, own, j = np.zeros(len(lanes), np.int32), lanes, i
            while len(own):
                to = base[at] + text[j, own] + 1
                ok = check[to] == at
                own, at = own[ok], to[ok]
                k = value[at]
                hit = k >= 0
                lane, k = own[hit], k[hit]
                if len(lane):
                    s = best[i, lane] + score[k]
                    alone[lane[after[i, lane] == j + 1]] = True
                    better = s > best[j + 1, lane]
                    lane = lane[better]
                    best[j + 1, lane], source[j + 1, lane], piece[j + 1, lane] = s[better], i, k[better]
                j += 1
                live = sizes[own] > j
                own, at = own[live], at[live]
            lane = lanes[~alone[lanes]]
            to = after[i, lane]
            better = best[i, lane] + self.unknown > best[to, lane]
            lane, to = lane[better], to[better]
            best[to, lane], source[to, lane], piece[to, lane] = best[i, lane] + self.unknown, i, -1
        out = []
        source_of, piece_of = source.T.tolist(), piece.T.tolist()
        for k, p in enumerate(parts):
            ids, j = [], len(p)
            while j:
                i, x = source_of[k][j], piece_of[k][j]
                if x >= 0:
                    ids.append(self.normal[x])
                else:
                    ids.extend(self.byte_id[b] for b in reversed(p[i:j]))
                j = i
            out.append(np.array(ids[::-1], np.int32))
        return out


class Encoder:
    """Encodes and decodes texts, keeping the encodings of segments that it has met."""

    def __init__(self, model: Model):
        self.model = model
        self._cache = SegmentCache(self._new, KEPT)
        surface = [_UNKNOWN_TEXT if k == 0 and not s else s for k, s in enumerate(model.surface)]
        self._size = np.array([len(s) for s in surface])
        self._bytes = np.frombuffer(b"".join(surface), np.uint8).copy()
        is_byte = np.zeros(len(surface), bool)
        is_byte[model.byte_id] = True
        self._bytes[(self._bytes == MARKER) & ~np.repeat(is_byte, self._size)] = 0x20
        self._start = np.cumsum(self._size) - self._size

    def _new(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.segment(parts)
        return np.concatenate(found), np.array([len(f) for f in found])

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the offsets of each text's."""
        full = np.flatnonzero(np.diff(at))
        marked = np.insert(np.where(raw == 0x20, np.uint8(MARKER), raw), at[full], MARKER)
        moved = at + np.searchsorted(full, np.arange(len(at)))
        lead = marked == MARKER
        lead[1:] &= marked[:-1] != MARKER
        lead[moved[:-1][full]] = True
        start = np.flatnonzero(lead)
        end = np.append(start[1:], len(marked))
        ids, total = self._cache(marked, start, end)
        return ids, total[np.searchsorted(start, moved)]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The UTF-8 bytes of all texts, and their offsets; the first space of each is the marker in front."""
        size = self._size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        raw = self._bytes[np.arange(total[-1]) + np.repeat(self._start[ids] - total[:-1], size)]
        ends = total[at]
        full = np.flatnonzero(np.diff(ends))
        front = ends[:-1][full]
        drop = raw[front] == 0x20
        keep = np.ones(len(raw), bool)
        keep[front[drop]] = False
        fewer = np.zeros(len(at), np.int64)
        fewer[full[drop] + 1] = 1
        return raw[keep], ends - np.cumsum(fewer)


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of ``text``.

    An empty text has no ids, a null text null; texts of any length are encoded whole. A
    column ``ids`` of ``docs``, in any case, is replaced. Rows are encoded one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        encoder = Encoder(shared.value)
        for texts in batches:
            raw, at = words.utf8(texts)
            lists = [pa.array([], pa.list_(pa.int32()))]
            for i, j in words.runs(at, RUN_BYTES):
                ids, first = encoder.encode(raw[at[i] : at[j]], at[i : j + 1] - at[i])
                lists.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()), mask=texts.slice(i, j - i).is_null()))
            yield pa.table({"ids": pa.concat_arrays(lists)})

    return work.with_fields(docs, work.of_text(run, StructType.fromDDL("ids array<int>"))(F.col("text")), ["ids"])


def decode(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``; null ids give null.

    Bytes that are no UTF-8 become U+FFFD, control ids nothing and the unknown id ``' ⁇ '``.
    A column ``decoded`` of ``rows``, in any case, is replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Table]:
        encoder = Encoder(shared.value)
        for given in batches:
            texts: list[str | None] = []
            for k in range(0, len(given), 1000):
                lists = given.slice(k, 1000)
                size = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64)
                raw, at = encoder.decode(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)]))
                data = raw.tobytes()
                spans = zip(lists.is_valid().to_pylist(), at[:-1].tolist(), at[1:].tolist())
                texts += [data[i:j].decode("utf-8", "replace") if there else None for there, i, j in spans]
            yield pa.table({"decoded": pa.array(texts, pa.string())})

    return work.with_fields(rows, work.of_text(run, StructType.fromDDL("decoded string"))(F.col("ids")), ["decoded"])


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_ids, ids, restored`` of each row: its pieces, and whether they decode to its text.

    A null text has null ids, of which there are 0, and counts as restored.
    """
    work.small_batches(docs.sparkSession)
    model = Model.load(path)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            raw, at = words.utf8(batch["text"])
            for i, j in words.runs(at, RUN_BYTES):
                own, begins = raw[at[i] : at[j]], at[i : j + 1] - at[i]
                ids, first = encoder.encode(own, begins)
                back, ends = encoder.decode(ids, first)
                same = np.diff(ends) == np.diff(begins)
                if not same.all() or not np.array_equal(back, own):
                    same &= [np.array_equal(back[ends[k] : ends[k + 1]], own[begins[k] : begins[k + 1]]) for k in range(j - i)]
                part = batch.slice(i, j - i)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids), mask=part["text"].is_null())
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(np.diff(first), pa.int64()), lists, pa.array(same)], ["doc_id", "n_ids", "ids", "restored"])
        del encoder
        work.release()

    doc_id = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_id}, n_ids long, ids array<int>, restored boolean")


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path())
