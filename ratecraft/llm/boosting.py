"""Gradient-boosted trees for two classes, on binned features (a small model fitted on a bounded sample)."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, second-order leaf values; every tree is complete to its depth."""

    def __init__(self, trees: int = 30, depth: int = 4, rate: float = 0.3, bins: int = 32, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1], method="higher")) for c in x.T]
        codes = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T, strict=True)], axis=1)
        mean = np.clip((y * weight).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), self.base)
        # arrays by tree, node in heap order
        size = 1 << self.depth
        self.feature = np.zeros((self.trees, size), np.int64)
        self.cut = np.full((self.trees, size), np.inf, np.float32)
        self.leaf = np.zeros((self.trees, size))
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (y - p), weight * p * (1 - p)
            node = np.ones(len(y), np.int64)
            for level in range(self.depth):
                self._split(t, level, codes, node, g, h)
                node = 2 * node + (x[np.arange(len(y)), self.feature[t, node]] > self.cut[t, node])
            leaf = node - size
            sums = np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.least)
            self.leaf[t] = self.rate * sums
            margin += self.leaf[t, leaf]
        return self

    def _split(self, t, level, codes, node, g, h) -> None:
        """The best cut of every node of a level."""
        first, width = 1 << level, self.bins
        best = np.full(first, 1e-6)
        local = node - first
        for f in range(codes.shape[1]):
            if not len(self.cuts[f]):
                continue
            at = local * width + codes[:, f]
            gs = np.bincount(at, g, first * width).reshape(first, width).cumsum(axis=1)
            hs = np.bincount(at, h, first * width).reshape(first, width).cumsum(axis=1)
            gt, ht = gs[:, -1:], hs[:, -1:]
            gain = gs ** 2 / (hs + self.least) + (gt - gs) ** 2 / (ht - hs + self.least) - gt ** 2 / (ht + self.least)
            gain = gain[:, :len(self.cuts[f])]
            k = gain.argmax(axis=1)
            value = gain[np.arange(first), k]
            better = np.flatnonzero(value > best)
            best[better] = value[better]
            self.feature[t, first + better] = f
            self.cut[t, first + better] = self.cuts[f][k[better]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the positive class."""
        rows, margin = np.arange(len(x)), np.full(len(x), self.base)
        for t in range(self.trees):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (x[rows, self.feature[t, node]] > self.cut[t, node])
            margin += self.leaf[t, node - (1 << self.depth)]
        return margin
