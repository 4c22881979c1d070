"""Words and word n-grams of whole Arrow batches, in numpy.

The texts of an Arrow string array lie in one UTF-8 buffer. All word patterns of this
folder separate words at ASCII bytes only, so words are found on the bytes, and no text
is ever decoded. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are worked on in runs of about so many bytes, so memory does not follow the batch size.
RUN_BYTES = 400_000
#: Bits of the first look at a hash in ``Lookup``.
TABLE_BITS = 22

# Odd multipliers of a 64-bit mixer; any odd numbers of this size would do.
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

#: True for bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: True for bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after A-Z became a-z).
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``, modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``n + 1`` offsets between them. Null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


@dataclass
class Words:
    """Words in text order: byte ranges in ``raw``, and the text that each belongs to."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray  # of each text, the place of its first word; n_texts + 1 values

    def hashes(self) -> np.ndarray:
        return range_hashes(self.raw, self.start, self.end)


def folded(raw: np.ndarray) -> np.ndarray:
    """A-Z as a-z."""
    return _FOLD[raw]


def split(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Longest runs of bytes that ``inside`` holds; none passes the end of a text."""
    member = np.zeros(len(raw) + 1, bool)
    member[:-1] = inside[raw]
    begins = member.copy()
    begins[1:] &= ~member[:-1]
    cut = offsets[1:-1]
    begins[cut] = member[cut]
    ends = np.zeros(len(raw) + 1, bool)
    ends[1:] = member[:-1] & ~member[1:]
    ends[cut[cut > 0]] |= member[cut[cut > 0] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(raw, start, end, text, first)


class RangeHashes:
    """Hashes of byte ranges of one buffer.

    A running sum of byte values times powers gives a range as one difference, which the
    inverse power moves to place 0.
    """

    def __init__(self, raw: np.ndarray):
        up, self._down = _power_tables(len(raw))
        self._total = np.zeros(len(raw) + 1, np.uint64)
        np.multiply(_BYTE[raw], up[: len(raw)], out=self._total[1:])
        np.cumsum(self._total, out=self._total)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._total[end] - self._total[start]) * self._down[start] + (end - start).astype(np.uint64))


def range_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each range."""
    return RangeHashes(raw)(start, end)


_TABLES: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) <= n:
        size = max(n + 1, RUN_BYTES + 1)
        tables = powers(size), powers(size, pow(_BASE, -1, 2**64))
        if n > 16 * RUN_BYTES:
            return tables  # a rare giant; not kept
        _TABLES[:] = tables
    return _TABLES[0], _TABLES[1]


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` words in a row, whether or not one text holds them."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for j, m in enumerate(powers(n + 1)[1:]):
        out += hashes[j : len(hashes) - n + 1 + j] * m
    out += np.uint64(n)
    return mix(out)


def within(text: np.ndarray, n: int) -> np.ndarray:
    """True at the start of every ``n`` words in a row that one text holds."""
    if len(text) < n:
        return np.empty(0, bool)
    return text[: len(text) - n + 1] == text[n - 1 :]


class Lookup:
    """Places of hashes in a sorted table, by a bit table that turns most others away."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.some = np.zeros(1 << TABLE_BITS, bool)
        self.some[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are in the table, and where."""
        which = np.flatnonzero(self.some[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        at = np.searchsorted(self.keys, hashes[which])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == hashes[which] if len(self.keys) else np.zeros(len(which), bool)
        return which[hit], at[hit]


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash of ``n`` words), by text and hash; fewer words, if any, are one shingle."""
    hashes = words.hashes()
    counts = np.diff(words.first)
    whole = within(words.text, n)
    value, text = ngrams(hashes, n)[whole], words.text[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        few = np.array([ngrams(hashes[words.first[t] : words.first[t + 1]], int(counts[t]))[0] for t in short], np.uint64)
        value, text = np.concatenate([value, few]), np.concatenate([text, short])
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return text[new], value[new]
