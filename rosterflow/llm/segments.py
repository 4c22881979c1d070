"""Encodings of text segments, made once for equal segments of a task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from rosterflow.llm import words

#: Distinct segments whose encodings a task keeps, and their bytes; beyond either it begins anew.
KEPT, KEPT_BYTES = 600_000, 24_000_000
#: Longer segments seldom come again; their encodings are not kept.
LONGEST_KEPT = 256


class SegmentCache:
    """``encode`` gives the ids of all segments in a row, and how many each has.

    Segments are known by their 64-bit hashes, in a sorted array, so that only new ones become
    Python objects.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kept: int = KEPT):
        self._encode, self._kept = encode, kept
        self._forget()

    def _forget(self) -> None:
        self._known, self._slot = np.empty(0, np.uint64), np.empty(0, np.int64)
        self._bytes = 0
        self._ids, self._first = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _slots(self, value: np.ndarray, whole: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of each segment, by sorted hashes, and the ids of all places with the offsets between them."""
        if len(self._known) > self._kept or self._bytes > KEPT_BYTES:
            self._forget()
        at = np.searchsorted(self._known, value)
        new = np.ones(len(value), bool)
        inside = at < len(self._known)
        new[inside] = self._known[at[inside]] != value[inside]
        slot = np.empty(len(value), np.int64)
        slot[~new] = self._slot[at[~new]]
        long = new & (end - start > LONGEST_KEPT)
        short = np.flatnonzero(new & ~long)
        if len(short):
            slot[short] = len(self._known) + np.arange(len(short))
            self._ids, self._first = self._more(self._ids, self._first, whole, start[short], end[short])
            self._bytes += int((end[short] - start[short]).sum())
            self._known = np.insert(self._known, at[short], value[short])
            self._slot = np.insert(self._slot, at[short], slot[short])
        if not long.any():
            return slot, self._ids, self._first
        slot[long] = len(self._known) + np.arange(long.sum())
        return slot, *self._more(self._ids, self._first, whole, start[long], end[long])

    def _more(self, ids: np.ndarray, first: np.ndarray, whole: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        more, sizes = self._encode([whole[i:j] for i, j in zip(start.tolist(), end.tolist())])
        return np.concatenate([ids, more]), np.concatenate([first, first[-1] + np.cumsum(sizes)])

    def __call__(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all segments in a row, and the ``len(start) + 1`` offsets between them."""
        if not len(start):
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        value, one, which = np.unique(words.range_hashes(raw, start, end), return_index=True, return_inverse=True)
        slot, ids, first = self._slots(value, raw.tobytes(), start[one], end[one])
        slot = slot[which]
        size = first[slot + 1] - first[slot]
        total = np.concatenate([[0], np.cumsum(size)])
        return ids[np.arange(total[-1]) + np.repeat(first[slot] - total[:-1], size)], total
