"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, BINS, RATE, LEAST = 100, 5, 32, 0.2, 20.0


@dataclass
class Boosted:
    cuts: list[np.ndarray]  # ascending, for each feature
    start: float
    # for each tree and inner node in level order: feature and bin; a value up to the bin goes left
    features: np.ndarray
    bins: np.ndarray
    leaves: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = _binned(x, self.cuts)
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.bins, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            z += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-z))


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    columns = [np.searchsorted(cut, x[:, f], side="left") for f, cut in enumerate(cuts)]
    return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0), np.int64)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Fit ``y`` (0 to 1) by second-order boosting of the weighted log loss."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = _binned(x, cuts)
    n_features = x.shape[1]
    flat = binned + np.arange(n_features) * (BINS + 1)
    mean = float(np.average(y, weights=weight))
    start = float(np.log(mean / (1 - mean)))
    z = np.full(len(x), start)
    inner, ends = 2**DEPTH - 1, 2**DEPTH
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS)
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, n_features * (BINS + 1)
            cell = ((at - first)[:, None] * width + flat).ravel()
            shape = (2**level, n_features, BINS + 1)
            sums = [
                np.bincount(cell, np.repeat(v, n_features), 2**level * width).reshape(shape).cumsum(axis=2)
                for v in (g, h)
            ]
            (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gt**2 / (ht + 1)
            gain[(hl < LEAST / 4) | (hr < LEAST / 4)] = 0
            best = gain.reshape(2**level, -1).argmax(axis=1)
            split = gain.reshape(2**level, -1).max(axis=1) > 1e-9
            feature[first : first + 2**level] = np.where(split, best // (BINS + 1), 0)
            cut[first : first + 2**level] = np.where(split, best % (BINS + 1), BINS)
            at = 2 * at + 1 + (binned[np.arange(len(x)), feature[at]] > cut[at])
        leaf = RATE * np.bincount(at - inner, g, ends) / (np.bincount(at - inner, h, ends) + 1)
        z += leaf[at - inner]
        trees.append((feature, cut, leaf))
    return Boosted(cuts, start, *(np.stack(part) for part in zip(*trees)))
