"""Token ids of text segments, computed once per distinct segment and worker.

A segment is known by the 64-bit hash of its bytes. The ids of the segments a
worker has met are kept in flat numpy arrays (up to ``CACHED`` segments, about
30 bytes each), so a batch of texts costs one sort of its segment hashes, one
encoder call for the segments not met before, and one gather.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

CACHED = 1_500_000

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]  # -> (all ids, ids per segment)


class SegmentIds:
    def __init__(self, encode: Encode):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def ids(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in order, and how many each segment has."""
        if not len(hashes):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > CACHED:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        if not known.all():
            self._learn(keys[~known], place[~known], at[~known], starts, ends, data)
            place = np.searchsorted(self.keys, keys)
        counts, first = self.count[place][back], self.first[place][back]
        past = np.cumsum(counts)
        take = np.repeat(first - (past - counts), counts) + np.arange(past[-1])
        return self.flat[take], counts

    def _learn(self, keys, place, at, starts, ends, data) -> None:
        raw = data.tobytes()
        segments = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        ids, counts = self.encode(segments)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        first = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        self.keys = np.insert(self.keys, place, keys)
        self.first = np.insert(self.first, place, first)
        self.count = np.insert(self.count, place, counts)
