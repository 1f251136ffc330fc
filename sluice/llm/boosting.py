"""Gradient-boosted regression trees for two classes, on binned features."""

from __future__ import annotations

import numpy as np


class Booster:
    """Log-odds as a sum of small trees, fitted one after the other to the gradient of the log loss."""

    def __init__(self, rounds: int = 90, depth: int = 4, rate: float = 0.25, bins: int = 32, smooth: float = 2.0, least: float = 5.0):
        self.rounds, self.depth, self.rate, self.bins, self.smooth, self.least = rounds, depth, rate, bins, smooth, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Booster:
        n, f = x.shape
        self.cuts = []
        for j in range(f):
            values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="nearest"))
            self.cuts.append(values)
        binned = self._bin(x)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        self.trees = []
        offsets = np.arange(f) * self.bins
        inner = 2 ** self.depth - 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            feature, cut = np.zeros(inner, np.int64), np.full(inner, self.bins, np.int64)  # a cut beyond all bins sends all left
            at = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width = 2 ** level - 1, 2 ** level
                cell = ((at - first)[:, None] * (f * self.bins) + offsets + binned).ravel()
                size = width * f * self.bins
                g = np.bincount(cell, np.repeat(grad, f), size).reshape(width, f, self.bins).cumsum(2)
                h = np.bincount(cell, np.repeat(hess, f), size).reshape(width, f, self.bins).cumsum(2)
                gt, ht = g[:, :, -1:], h[:, :, -1:]
                gain = g ** 2 / (h + self.smooth) + (gt - g) ** 2 / (ht - h + self.smooth) - gt ** 2 / (ht + self.smooth)
                gain[(h < self.least * 0.05) | (ht - h < self.least * 0.05)] = 0
                best = gain.reshape(width, -1).argmax(1)
                useful = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
                feature[first:first + width] = best // self.bins
                cut[first:first + width] = np.where(useful, best % self.bins, self.bins)
                right = binned[np.arange(n), feature[at]] > cut[at]
                at = 2 * at + 1 + right
            leaf = at - inner
            leaves = 2 ** self.depth
            value = self.rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + self.smooth)
            score += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], 1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 per row of ``x``."""
        out = np.full(len(x), self.base)
        if not len(x):
            return out
        binned, rows = self._bin(x), np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            out += value[at - len(feature)]
        return out
