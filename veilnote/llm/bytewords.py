"""Words, n-grams and hashes of UTF-8 texts as numpy arrays over Arrow's buffers.

Hashes have 64 bits. A word of up to 8 bytes has a hash of its own; longer words and n-grams are mixed, so different
ones share a hash with a chance of 2**-64 a pair.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time, unless one document is longer.
SLICE = 1 << 21

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but white space.
BLANK_SPLIT = np.ones(256, bool)
BLANK_SPLIT[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, lower-case letters and all bytes of characters beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[48:58] = LETTERS[97:123] = LETTERS[128:] = True

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each text starts and ends (one more offset than texts). Null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of documents of up to `most` bytes; a longer document is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(low: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word: a run of bytes of the kind, within one document."""
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = kind[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    h = h * _ODD[0]
    h ^= h >> np.uint64(32)
    h *= _ODD[1]
    h ^= h >> np.uint64(29)
    return h


def hash_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each word, eight bytes at a time."""
    padded = np.zeros(len(low) + 8, np.uint8)
    padded[:len(low)] = low
    eights = np.ndarray((len(low) + 1,), np.dtype("<u8"), padded, 0, (1,))
    left, at = ends - starts, starts
    out = left.astype(np.uint64) * _ODD[2]
    live = np.arange(len(starts))
    while len(live):
        out[live] = mix(out[live] ^ (eights[at] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return out


def hash_grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place where n words of one document follow one another: index of the first word, and the hash."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:])
    out = np.full(len(first), n, np.uint64)
    for k in range(n):
        out = mix(out * _ODD[2] + hashes[first + k])
    return first, out
