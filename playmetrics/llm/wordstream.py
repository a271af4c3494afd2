"""Words of a text column as numpy arrays, straight from the Arrow buffers.

Words are maximal runs of bytes other than space and 0x09-0x0D; in UTF-8 those
bytes never occur inside another character. Every word gets a 64-bit hash of
its bytes after lower-casing A-Z: a polynomial in an odd multiplier over random
byte values, mixed at the end. Equal words have equal hashes; two different
words share one with a probability of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MULTIPLIER = 0x9E3779B97F4A7C15


EXACT = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2)
EXACT |= np.uint64(1)
FOLDED = EXACT.copy()  # A-Z read as a-z
FOLDED[ord("A"):ord("Z") + 1] = EXACT[ord("a"):ord("z") + 1]
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least ``n`` of each."""
    global _POWERS, _INVERSES
    while len(_POWERS) < n:
        step = len(_POWERS)
        _POWERS = np.concatenate([_POWERS, _POWERS * np.uint64(pow(_MULTIPLIER, step, 1 << 64))])
        back = pow(pow(_MULTIPLIER, -1, 1 << 64), step, 1 << 64)
        _INVERSES = np.concatenate([_INVERSES, _INVERSES * np.uint64(back)])
    return _POWERS, _INVERSES


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible scrambling of 64-bit values (the murmur3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass(frozen=True)
class Words:
    """``hashes[offsets[i]:offsets[i + 1]]`` are row i's words; ``data[start:end]`` their bytes."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes; ``values`` holds one odd 64-bit value per byte."""
    powers, inverses = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])


def _split(data: np.ndarray, offsets: np.ndarray, values: np.ndarray,
           outside: np.ndarray = _SPACE) -> Words:
    inside = ~outside[data]
    n = len(data)
    cuts = offsets[:-1][offsets[:-1] < n]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    inner = cuts[cuts > 0] - 1
    last[inner] = inside[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = span_hashes(data, starts, ends, values)
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, data)


def _shape_classes() -> np.ndarray:
    classes = np.arange(256, dtype=np.uint8)
    classes[ord("A"):ord("Z") + 1] = ord("A")
    classes[ord("a"):ord("z") + 1] = ord("a")
    classes[0x80:] = ord("a")
    classes[ord("0"):ord("9") + 1] = ord("9")
    return classes


_CLASSES = _shape_classes()


def shape_hashes(words: Words) -> np.ndarray:
    """Hash of each word's shape: letters read A or a, digits 9, and runs of one class shrink to one."""
    if not len(words.starts):
        return np.zeros(0, dtype=np.uint64)
    classes = _CLASSES[words.data]
    keep = np.ones(len(classes), dtype=bool)
    keep[1:] = classes[1:] != classes[:-1]
    keep[words.starts] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    kept = classes[keep]
    return span_hashes(kept, before[words.starts], before[words.ends], EXACT)


def byte_slices(column: pa.Array,
                most_bytes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows of at most ``most_bytes``, or one longer row."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        width, kind = 8, np.int64
    else:
        width, kind = 4, np.int32
    if len(column) == 0:
        return
    _, offsets_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offsets_buffer, kind, len(column) + 1,
                            column.offset * width).astype(np.int64)
    data = (np.frombuffer(data_buffer, np.uint8) if data_buffer is not None
            else np.zeros(0, np.uint8))
    row = 0
    while row < len(column):
        past = int(np.searchsorted(offsets, offsets[row] + most_bytes, side="right")) - 1
        past = min(max(past, row + 1), len(column))
        yield row, data[offsets[row]:offsets[past]], offsets[row:past + 1] - offsets[row]
        row = past


def slices(column: pa.Array, most_bytes: int = SLICE_BYTES, fold: bool = True,
           outside: np.ndarray = _SPACE) -> Iterator[tuple[int, Words]]:
    """(first row, words) for runs of rows; ``fold`` lower-cases A-Z in the hashes.

    ``outside`` marks the bytes that are no part of a word: white space, unless given.
    """
    for row, data, offsets in byte_slices(column, most_bytes):
        yield row, _split(data, offsets, FOLDED if fold else EXACT, outside)


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's ``width``-word shingles, and their offsets.

    A row with fewer words has its whole sequence as the one shingle; a row
    without words has none.
    """
    counts = np.diff(words.offsets)
    n = len(words.hashes)
    rng = np.random.default_rng(width)
    factors = rng.integers(0, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        rolled += words.hashes[k:k + len(rolled)] * factors[k]
    row = np.repeat(np.arange(len(counts)), counts)
    ok = np.zeros(len(rolled), dtype=bool)
    if len(rolled):
        ok = row[:len(rolled)] == row[width - 1:]
    values, rows = mix(rolled[ok]), row[:len(rolled)][ok]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        lone = [_short_hash(words.hashes[words.offsets[i]:words.offsets[i + 1]], factors)
                for i in short.tolist()]
        values = np.concatenate([values, np.array(lone, dtype=np.uint64)])
        rows = np.concatenate([rows, short])
    # rows are few, so sorting by value and then stably by row beats a two-key sort
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(rows[order].astype(np.int32), kind="stable")]
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[fresh], rows[fresh]
    return values, np.searchsorted(rows, np.arange(len(counts) + 1))


def _short_hash(hashes: np.ndarray, factors: np.ndarray) -> int:
    # the length keeps "a b" apart from any longer sequence
    total = (hashes * factors[:len(hashes)]).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(mix(np.array([total], dtype=np.uint64))[0])
