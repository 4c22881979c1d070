"""Exact counts of hashed keys over all documents, by packed blocks and buckets.

A row for every n-gram would move several times the bytes of the texts. Instead the
documents are dealt into *blocks* of a few megabytes. A block sends each *bucket* (a
range of the hash space) one row with the block's distinct hashes of that range, sorted
and packed as gaps, and their counts in the block. A bucket adds up the counts of all
blocks and answers each block with the totals in the order of its request. Blocks then
meet their documents again, make the same keys and know the count of each.

* A key that a third of all documents hold reaches its bucket once per block.
* Blocks and buckets are of bounded size; their numbers follow the measured input. A row
  holds at least one hash, so there are never more rows than n-grams.
* A block is fixed by its rows alone, so a repeated task gives the same answer.
* Hashes are 64 bits wide, so that counts are those of the keys. A plan that is ``narrow``,
  for counts that only choose candidates, has hashes as wide as the input needs for a key
  to meet another with a chance of about one in 2 ** SPARE_BITS.
* In a ``packed`` plan, texts and counts travel as zstd frames, which the exchange's own
  codec would leave larger: a frame of text is smaller by a third, one of counts by half.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm import work

#: Bits of a narrow hash beyond those that number the characters of the input.
SPARE_BITS = 19
BLOCK_CHARS = 8_000_000
PACKED = "block int, bucket int, width int, gaps binary, counts binary, large binary"
_SCHEMA = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("width", pa.int32()), ("gaps", pa.binary()), ("counts", pa.binary()), ("large", pa.binary())])
_LARGE = 255
#: Level of zstd frames.
_LEVEL = 3


def _frames(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Each text as a zstd frame of its UTF-8 bytes; null stays null."""
    squeeze = zstandard.ZstdCompressor(level=_LEVEL).compress
    for texts in batches:
        yield pa.array([None if t is None else squeeze(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


@dataclass(frozen=True)
class Plan:
    """How many blocks, and buckets, how wide hashes are, and whether texts and counts travel packed."""

    n: int
    bits: int
    packed: bool = False

    @classmethod
    def of(cls, docs: DataFrame, chars: int = BLOCK_CHARS, narrow: bool = False, packed: bool = False) -> Plan:
        total = docs.agg(F.sum(F.length("text"))).first()[0] or 1
        return cls(max(1, math.ceil(total / chars)), min(64, total.bit_length() + SPARE_BITS) if narrow else 64, packed)

    @property
    def step(self) -> int:
        return min(2**self.bits // self.n + 1, 2**64 - 1)

    def short(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes // np.uint64(self.step)).astype(np.int64)

    def blocks(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``block``, shuffled by it. The text counts too, so rows without an id spread."""
        dealt = docs.withColumn("block", F.expr(f"cast(pmod(xxhash64(doc_id, text), {self.n}) as int)"))
        if self.packed:
            work.small_batches(docs.sparkSession)
            dealt = dealt.withColumn("text", F.arrow_udf(_frames, "binary")("text"))
        return dealt.repartition(self.n, "block")

    def opened(self, table: pa.Table) -> pa.Table:
        """A block's rows with their texts as strings."""
        if not self.packed:
            return table
        read = zstandard.ZstdDecompressor().decompress
        texts = [None if t is None else read(t) for t in table["text"].to_pylist()]
        return table.set_column(table.column_names.index("text"), "text", pa.array(texts, pa.large_binary()).cast(pa.large_string()))

    def pack_counts(self, counts: np.ndarray) -> tuple[bytes, bytes]:
        small, large = _pack_counts(counts)
        return (zstandard.ZstdCompressor(level=_LEVEL).compress(small), large) if self.packed else (small, large)

    def unpack_counts(self, small: bytes, large: bytes) -> np.ndarray:
        return _unpack_counts(zstandard.ZstdDecompressor().decompress(small) if self.packed else small, large)


Keys = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def _pack_counts(counts: np.ndarray) -> tuple[bytes, bytes]:
    return np.minimum(counts, _LARGE).astype(np.uint8).tobytes(), counts[counts >= _LARGE].astype("<i8").tobytes()


def _unpack_counts(small: bytes, large: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == _LARGE] = np.frombuffer(large, "<i8")
    return counts


def _cuts(bucket: np.ndarray) -> list[tuple[int, int]]:
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    return list(zip(at, [*at[1:], len(bucket)]))


def totals(blocks: DataFrame, keys: Keys, plan: Plan) -> DataFrame:
    """For each block and bucket, the counts over all blocks of the block's keys there.

    ``keys`` gives a block's distinct hashes, sorted, made ``plan.short``, and their counts.
    """

    def ask(table: pa.Table) -> pa.Table:
        work.release()
        hashes, counts = keys(plan.opened(table))
        bucket, block = plan.bucket(hashes), table["block"][0].as_py()
        rows: dict[str, list] = {name: [] for name in _SCHEMA.names}
        for i, j in _cuts(bucket):
            gaps = np.diff(hashes[i:j], prepend=np.uint64(int(bucket[i]) * plan.step))
            width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
            packed = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
            for name, value in zip(_SCHEMA.names, (block, int(bucket[i]), width, packed, *plan.pack_counts(counts[i:j]))):
                rows[name].append(value)
        return pa.table(rows, _SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        work.release()
        asked = []
        for row in table.select(["bucket", "width", "gaps"]).to_pylist():
            small = np.frombuffer(row["gaps"], np.uint8).reshape(-1, row["width"])
            wide = np.zeros((len(small), 8), np.uint8)
            wide[:, : row["width"]] = small
            asked.append(np.cumsum(wide.view("<u8").ravel()) + np.uint64(row["bucket"] * plan.step))
        hashes = np.concatenate(asked)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        own = np.concatenate([plan.unpack_counts(c, b) for c, b in zip(table["counts"].to_pylist(), table["large"].to_pylist())])
        total = np.empty(len(hashes), np.int64)
        total[order] = np.repeat(np.add.reduceat(own[order], first), np.diff(first, append=len(hashes)))
        packed = [plan.pack_counts(t) for t in np.split(total, np.cumsum([len(h) for h in asked])[:-1])]
        return pa.table([table["block"], table["bucket"], pa.array([c for c, _ in packed], pa.binary()), pa.array([b for _, b in packed], pa.binary())], ["block", "bucket", "counts", "large"])

    return blocks.groupBy("block").applyInArrow(ask, PACKED).groupBy("bucket").applyInArrow(answer, "block int, bucket int, counts binary, large binary")


class Totals:
    """A block's keys and their counts over all blocks."""

    def __init__(self, hashes: np.ndarray, told: pa.Table, plan: Plan):
        rows = sorted(told.select(["bucket", "counts", "large"]).to_pylist(), key=lambda r: r["bucket"])
        self.hashes = hashes
        self.counts = np.concatenate([np.empty(0, np.int64), *(plan.unpack_counts(r["counts"], r["large"]) for r in rows)])

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The counts of keys of this block."""
        return self.counts[np.searchsorted(self.hashes, hashes)]


def with_totals(blocks: DataFrame, answers: DataFrame, keys: Keys, then: Callable[[pa.Table, Totals], pa.Table], schema: str, plan: Plan) -> DataFrame:
    """``then(documents, totals)`` for each block; ``blocks``, ``keys`` and ``plan`` as ``totals`` got them."""

    def both(docs: pa.Table, told: pa.Table) -> pa.Table:
        work.release()
        docs = plan.opened(docs)
        return then(docs, Totals(keys(docs)[0], told, plan))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(both, schema)
