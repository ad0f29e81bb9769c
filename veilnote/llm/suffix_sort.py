"""Suffix array of one shard by induced sorting, and permuted longest common prefixes, on numpy arrays.

Induction visits the 258 buckets in order. What one bucket induces is spread over the later buckets at once by a stable
counting sort, and a run of one byte is induced as a whole, so the work is linear and Python only loops over buckets.
"""
from __future__ import annotations

import numpy as np

#: Values of the end of the shard and of the end of a piece; bytes follow, two higher.
END, GAP, SHIFT = 0, 1, 2
KINDS = 256 + SHIFT
#: Comparisons that are still open and so few go on one by one in long blocks, not all together by four values.
FEW = 64


def shard_text(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The pieces in one array, each with a gap after it, an end at the end; and where each piece starts."""
    size = np.array([len(p) + 1 for p in pieces], np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    text = np.full(at[-1] + 1, GAP, np.uint16)
    for p, start in zip(pieces, at[:-1], strict=True):
        text[start:start + len(p)] = p.astype(np.uint16) + SHIFT
    text[-1] = END
    return text, at[:-1]


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last suffix counts as such."""
    step = np.sign(np.diff(text.astype(np.int32)))
    out = np.ones(len(text), bool)
    changes = np.flatnonzero(step)
    out[:-1] = step[changes[np.searchsorted(changes, np.arange(len(step)))]] > 0
    return out


def _spread(at: np.ndarray, wanted: np.ndarray, text: np.ndarray, own: int, queues: list[list[np.ndarray]]) -> None:
    """Queues the wanted predecessors by their bucket, in order, but for those of the bucket itself."""
    before = at[at > 0] - 1
    before = before[wanted[before]]
    kinds = text[before]
    if own >= 0:
        other = kinds != own
        before, kinds = before[other], kinds[other]
    order = np.argsort(kinds, kind="stable")
    before, kinds = before[order], kinds[order]
    cuts = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
    if len(before):
        for part, kind in zip(np.split(before, cuts), kinds[np.append(0, cuts)], strict=True):
            queues[kind].append(part)


def _with_runs(now: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The suffixes and what they induce in their own bucket: the places before them in runs of one byte, first all
    that are one place before, then two, and so on. Linear in what it returns, however long a run is."""
    n = run[now]
    owner = np.repeat(np.arange(len(now)), n)
    back = np.arange(1, len(owner) + 1) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(back, kind="stable")
    return np.concatenate([now, (now[owner] - back)[order]])


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes, induced from leftmost-smaller ones given in order within each bucket."""
    none, larger = seeds[:0], ~smaller
    # Equal neighbours have one type, so a place's whole run before it is induced with it.
    heads = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    run = np.arange(len(text)) - np.repeat(heads, np.diff(np.append(heads, len(text))))
    kinds = text[seeds]
    order = np.argsort(kinds, kind="stable")
    cuts = np.searchsorted(kinds[order], np.arange(KINDS + 1))
    queues: list[list[np.ndarray]] = [[] for _ in range(KINDS)]
    left: list[np.ndarray] = []
    for kind in range(KINDS):
        left.append(_with_runs(np.concatenate([none, *queues[kind]]), run))
        _spread(left[kind], larger, text, kind, queues)
        _spread(seeds[order[cuts[kind]:cuts[kind + 1]]], larger, text, -1, queues)
    queues = [[] for _ in range(KINDS)]
    queues[END].append(np.array([len(text) - 1]))
    right: list[np.ndarray] = [none] * KINDS
    for kind in reversed(range(KINDS)):
        right[kind] = _with_runs(np.concatenate([none, *queues[kind]]), run)
        _spread(right[kind], smaller, text, kind, queues)
        _spread(left[kind][::-1], smaller, text, -1, queues)
    return np.concatenate([x for kind in range(KINDS) for x in (left[kind], right[kind][::-1])])


def _shared(text: np.ndarray, a: int, b: int, most: int) -> int:
    """How many values from a and b on are equal, `most` at most, in blocks that grow."""
    done, step = 0, 256
    while done < most:
        size = min(step, most - done)
        differ = text[a + done:a + done + size] != text[b + done:b + done + size]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + size, min(2 * step, 1 << 16)
    return most


def _chunks(text: np.ndarray) -> np.ndarray:
    """Four values from each place on, as one number."""
    padded = np.zeros(len(text) + 4, np.uint16)
    padded[:len(text)] = text
    return np.ndarray((len(text) + 1,), np.dtype("<u8"), padded, 0, (2,))


def _ranks(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a sequence of names, by doubling the length that is told apart."""
    rank, step = names, 1
    while len(rank) and rank.max() + 1 < len(rank):
        after = np.zeros(len(rank), np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new) - 1
        step *= 2
    return rank


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes, in order. The last value must be END and occur once."""
    smaller = smaller_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    rough = induce(text, smaller, leftmost)
    rough = rough[is_leftmost[rough]]
    index = np.empty(len(text), np.int64)
    index[leftmost] = np.arange(len(leftmost))
    size = np.diff(np.append(leftmost, len(text) - 1)) + 1
    a, b = rough[:-1], rough[1:]
    new = np.ones(len(rough), bool)
    new[1:] = size[index[a]] != size[index[b]]
    live, eights = np.flatnonzero(~new), _chunks(text)
    done = 0
    while len(live) > FEW:
        x, y, rest = rough[live - 1] + done, rough[live] + done, size[index[rough[live]]] - done
        mask = np.where(rest >= 4, ~np.uint64(0), (np.uint64(1) << (np.uint64(16) * np.minimum(rest, 3).astype(np.uint64))) - np.uint64(1))
        other = (eights[x] ^ eights[y]) & mask != 0
        new[live[other]] = True
        live = live[~other & (rest > 4)]
        done += 4
    for k in live.tolist():
        rest = int(size[index[rough[k]]]) - done
        new[k] = _shared(text, int(rough[k - 1]) + done, int(rough[k]) + done, rest) < rest
    names = np.empty(len(leftmost), np.int64)
    names[index[rough]] = np.cumsum(new) - 1
    ordered = np.empty(len(leftmost), np.int64)
    ordered[_ranks(names)] = leftmost
    return induce(text, smaller, ordered)


def permuted_prefixes(text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position: the suffix before it in order, and how long a prefix they share. Only positions whose
    predecessor bytes differ are compared; any other shares one less than the position before it."""
    before = np.empty(len(text), np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = order[0]
    shared = np.zeros(len(text), np.int64)
    compare = np.ones(len(text), bool)
    inner = (before > 0) & (np.arange(len(text)) > 0)
    compare[inner] = text[np.flatnonzero(inner) - 1] != text[before[inner] - 1]
    compare[order[0]] = True
    places = np.flatnonzero(compare)
    live, eights, done = places[places != order[0]], _chunks(text), 0
    while len(live) > FEW:
        differ = eights[np.minimum(live + done, len(text))] ^ eights[np.minimum(before[live] + done, len(text))]
        low = differ & (~differ + np.uint64(1))                # lowest bit that differs
        same = differ == 0
        shared[live] = done + np.where(same, 4, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 16)
        live, done = live[same], done + 4
    for k in live.tolist():
        other = int(before[k])
        shared[k] = done + _shared(text, k + done, other + done, len(text) - max(k, other) - done)
    last = places[np.searchsorted(places, np.arange(len(text)), "right") - 1]
    return before, np.maximum(shared[last] - (np.arange(len(text)) - last), 0)


def repeated_starts(pieces: list[np.ndarray], size: int) -> list[np.ndarray]:
    """For each piece, at which of its windows of `size` bytes it holds a window that starts elsewhere too."""
    if not pieces:
        return []
    text, at = shard_text(pieces)
    before, shared = permuted_prefixes(text, suffix_array(text))
    ends = np.repeat(at + np.array([len(p) for p in pieces]), np.array([len(p) + 1 for p in pieces]))
    fits = np.zeros(len(text), bool)
    fits[:-1] = np.arange(len(text) - 1) + size <= ends
    twice = fits & (shared >= size)
    twice[before[twice]] = True
    return [np.flatnonzero(twice[s:s + len(p)]) for p, s in zip(pieces, at, strict=True)]
