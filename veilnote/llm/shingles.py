"""Sets of distinct word shingles of whole texts."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from veilnote.llm.bytewords import BLANK_SPLIT, LOWER, hash_grams, hash_words, slices, utf8, words


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of documents lo..hi: the document of each distinct shingle and its hash, sorted by both.

    A-Z are lower-cased, words are split at ASCII white space. A text of fewer words than n, but not none, has its
    whole sequence as its one shingle; an empty or null text has none.
    """
    data, offsets = utf8(column)
    for lo, hi in slices(offsets):
        low, own = LOWER[data[offsets[lo]:offsets[hi]]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends, doc = words(low, own, BLANK_SPLIT)
        hashes = hash_words(low, starts, ends)
        first, grams = hash_grams(hashes, doc, n)
        owner = doc[first]
        count = np.bincount(doc, minlength=hi - lo)
        for k in range(1, n):
            if (count == k).any():
                first, short = hash_grams(hashes, doc, k)
                here = count[doc[first]] == k
                owner, grams = np.append(owner, doc[first][here]), np.append(grams, short[here])
        order = np.lexsort((grams, owner))
        owner, grams = owner[order], grams[order]
        new = np.ones(len(grams), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
        yield lo, hi, owner[new], grams[new]


def each_set(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted shingle hashes of each text."""
    out: list[np.ndarray] = []
    for lo, hi, owner, grams in shingle_sets(column, n):
        ends = np.searchsorted(owner, np.arange(hi - lo + 1))
        out += [grams[ends[k]:ends[k + 1]] for k in range(hi - lo)]
    return out
