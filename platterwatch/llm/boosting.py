"""Histogram gradient-boosted trees for two classes, in numpy.

Features are cut into at most BINS bins at quantiles of the training rows. A tree grows level by
level: one histogram of gradients and curvatures per node, feature and bin, and the split of largest
gain. All trees are flattened into arrays (feature, threshold, value, by place in a full tree), so that rows
walk down a tree together, a level a step.
"""

from __future__ import annotations

import numpy as np

BINS = 64


def edges(x: np.ndarray) -> list[np.ndarray]:
    """Thresholds of each feature; a value belongs to the bin of the number of thresholds below it."""
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(c, points, method="lower")) for c in x.T]


class Trees:
    def __init__(self, depth: int, base: float):
        self.depth, self.base = depth, base
        size = 2 ** (depth + 1) - 1
        self.feature = np.zeros((0, size), np.int32)
        self.threshold = np.zeros((0, size))
        self.value = np.zeros((0, size))

    def add(self, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray) -> None:
        self.feature = np.concatenate([self.feature, feature[None].astype(np.int32)])
        self.threshold = np.concatenate([self.threshold, threshold[None]])
        self.value = np.concatenate([self.value, value[None]])

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches. Node k's children are 2k + 1 and 2k + 2; an
        infinite threshold sends every row left, where the value is repeated."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def grow(binned, cuts, gradient, curvature, depth, l2, least):
    """(feature, threshold, value, leaf of each row) of one tree."""
    size = 2 ** (depth + 1) - 1
    feature = np.zeros(size, np.int64)
    threshold = np.full(size, np.inf)
    value = np.zeros(size)
    node = np.zeros(len(binned), np.int64)
    n_features = binned.shape[1]
    for level in range(depth + 1):
        first, width = 2**level - 1, 2**level
        place = node - first
        g = np.bincount(place, gradient, width)
        h = np.bincount(place, curvature, width)
        value[first : first + width] = -g / (h + l2)
        if level == depth:
            break
        best = np.full(width, 1e-9)
        bin_of = np.full(width, BINS, np.int64)
        for f in range(n_features):
            key = place * BINS + binned[:, f]
            hist_g = np.bincount(key, gradient, width * BINS).reshape(width, BINS).cumsum(1)
            hist_h = np.bincount(key, curvature, width * BINS).reshape(width, BINS).cumsum(1)
            right_g, right_h = g[:, None] - hist_g, h[:, None] - hist_h
            gain = hist_g**2 / (hist_h + l2) + right_g**2 / (right_h + l2) - (g**2 / (h + l2))[:, None]
            gain[(hist_h < least) | (right_h < least)] = 0
            gain[:, len(cuts[f]) :] = 0
            k = gain.argmax(1)
            better = gain[np.arange(width), k] > best
            best[better] = gain[better, k[better]]
            bin_of[better] = k[better]
            for n in np.flatnonzero(better):
                feature[first + n], threshold[first + n] = f, cuts[f][k[n]]
        goes = binned[np.arange(len(binned)), feature[node]] > bin_of[place]
        node = 2 * node + 1 + goes
    return feature, threshold, value, node


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
    l2: float = 1.0, least: float = 2.0,
) -> Trees:
    """Log-loss boosting. Rows of one class only give that class's share for every row."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Trees(depth, float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    cuts = edges(x)
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    raw = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        feature, threshold, value, leaf = grow(binned, cuts, p - y, p * (1 - p), depth, l2, least)
        model.add(feature, threshold, rate * value)
        raw += rate * value[leaf]
    return model
