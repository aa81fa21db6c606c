"""Gradient-boosted trees for a 0/1 target, in numpy, on quantile bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of equal depth: split feature and bin by node, value by leaf."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = _binned(x, self.edges)
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            z += value[at - (2**depth - 1)]
        return 1 / (1 + np.exp(-z))


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1).astype(np.int16)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, trees: int = 50, depth: int = 5, rate: float = 0.2, bins: int = 24, ridge: float = 2.0) -> Trees:
    """Newton boosting of the logistic loss; every tree is grown to ``depth``, useless splits keeping all rows left."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = _binned(x, edges).astype(np.int64)
    n, width = binned.shape
    share = np.average(y, weights=weight)
    base = float(np.log(share / (1 - share)))
    z = np.full(n, base)
    column = binned + np.arange(width) * bins
    inner = 2**depth - 1
    found = Trees(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), bins, np.int64), np.zeros((trees, inner + 1)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            flat = ((at - first)[:, None] * (width * bins) + column).ravel()
            sums = [np.bincount(flat, np.repeat(v, width), count * width * bins).reshape(count, width, bins) for v in (g, h)]
            left_g, left_h = (s.cumsum(axis=2) for s in sums)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            best = gain.reshape(count, -1).argmax(axis=1)
            useful = gain.reshape(count, -1)[np.arange(count), best] > 1e-9
            found.feature[t, first : first + count] = best // bins
            found.cut[t, first : first + count] = np.where(useful, best % bins, bins)
            at = 2 * at + 1 + (binned[np.arange(n), found.feature[t, at]] > found.cut[t, at])
        leaf = at - inner
        found.value[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        z += found.value[t, leaf]
    return found
