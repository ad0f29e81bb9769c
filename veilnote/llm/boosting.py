"""Gradient-boosted trees for two classes, fitted on a bounded sample, with isotonic calibration."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Tree:
    """Splits in heap order: value <= limit goes left. A leaf has feature -1."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def add_to(self, x: np.ndarray, out: np.ndarray) -> None:
        node = np.zeros(len(x), np.int64)
        while (inner := self.feature[node] >= 0).any():
            at = node[inner]
            node[inner] = 2 * at + 1 + (x[inner, self.feature[at]] > self.limit[at])
        out += self.value[node]

    def column(self, features: list[Column], node: int = 0) -> Column:
        if self.feature[node] < 0:
            return F.lit(float(self.value[node]))
        return F.when(features[self.feature[node]] <= float(self.limit[node]), self.column(features, 2 * node + 1)).otherwise(
            self.column(features, 2 * node + 2))


@dataclass
class Boosted:
    base: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            tree.add_to(x, out)
        return out

    def column(self, features: list[Column]) -> Column:
        """The same sum as a column expression."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + tree.column(features)
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64,
        least: float = 1.0) -> Boosted:
    """Newton steps on the logistic loss over binned features. Equal input gives equal trees."""
    rows, width = x.shape
    limits = [x[:0, 0] if not rows else np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(limits[f], x[:, f], "left") for f in range(width)], 1) if rows else np.zeros((0, width), np.int64)
    share = np.clip(y.mean() if rows else 0.5, 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    score = np.full(rows, model.base)
    size = 2 ** (depth + 1) - 1
    for _ in range(trees if rows and 0 < y.sum() < rows else 0):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)
        tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
        node = np.zeros(rows, np.int64)
        for at in range(size):
            here = np.flatnonzero(node == at)
            if not len(here):
                continue
            g, h = slope[here], bend[here]
            tree.value[at] = rate * g.sum() / (h.sum() + least)
            if at >= 2 ** depth - 1:
                continue
            best, choice = 1e-6, None
            for f in range(width):
                if len(limits[f]) == 0:
                    continue
                count = len(limits[f]) + 1
                left_g = np.cumsum(np.bincount(binned[here, f], g, count))[:-1]
                left_h = np.cumsum(np.bincount(binned[here, f], h, count))[:-1]
                right_g, right_h = g.sum() - left_g, h.sum() - left_h
                gain = left_g**2 / (left_h + least) + right_g**2 / (right_h + least) - g.sum() ** 2 / (h.sum() + least)
                gain[(left_h < least / 4) | (right_h < least / 4)] = 0
                if gain.max() > best:
                    best, choice = gain.max(), (f, int(gain.argmax()))
            if choice:
                f, k = choice
                tree.feature[at], tree.limit[at] = f, limits[f][k]
                node[here] = 2 * at + 1 + (binned[here, f] > k)
        tree.add_to(x, score)
        model.trees.append(tree)
    return model


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function of raw with the least squared error (pooling of adjacent violators).
    Each block has one more positive and negative of weight 1/2, so that no score is 0 or 1."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for r, target in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([target, 1.0, r, r])
        while len(blocks) > 1 and (blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1] or blocks[-2][3] == blocks[-1][2]):
            total, n, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2], hi]
    knots, values = [], []
    for total, n, lo, hi in blocks:
        value = (total + 0.5) / (n + 1)
        knots += [lo, hi] if hi > lo else [lo]
        values += [value, value] if hi > lo else [value]
    if not knots:
        return np.array([0.0]), np.array([0.5])
    return np.array(knots), np.maximum.accumulate(np.array(values))


def calibrated(raw: np.ndarray, knots: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Between the knots in a straight line, beyond them flat."""
    return np.interp(raw, knots, values)
