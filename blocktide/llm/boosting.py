"""Boosted decision trees for small, bounded training sets, on numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Complete binary trees: at inner node i go right if feature > threshold."""

    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray
    leaves: np.ndarray  # trees x leaves
    base: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        inner = self.features.shape[1]
        at_row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):  # a level of the tree
                node = 2 * node + 1 + (x[at_row, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated chance of the positive class."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0
) -> Trees:
    """Gradient boosting of the logistic loss with histogram splits (Newton leaves)."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    inner, share = 2**depth - 1, float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    features = np.zeros((rounds, inner), np.int64)
    thresholds = np.full((rounds, inner), np.inf)
    leaves = np.zeros((rounds, inner + 1))
    column = np.arange(width)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width + column) * BINS + binned
            shape = (count, width, BINS)
            gs = np.bincount(place.ravel(), np.repeat(g, width), count * width * BINS).reshape(shape)
            hs = np.bincount(place.ravel(), np.repeat(h, width), count * width * BINS).reshape(shape)
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain = gain.reshape(count, -1)
            best = gain.argmax(1)
            for i in range(count):
                f, b = divmod(int(best[i]), BINS)
                if gain[i, best[i]] > 1e-6 and b < len(edges[f]):
                    features[t, first + i], thresholds[t, first + i] = f, edges[f][b]
            right = x[np.arange(n), features[t, node]] > thresholds[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        gsum, hsum = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        leaves[t] = rate * gsum / (hsum + ridge)
        margin += leaves[t][leaf]
    return Trees(features, thresholds, leaves, base)


def calibrate(trees: Trees, x: np.ndarray, y: np.ndarray, steps: int = 50) -> None:
    """Fit slope and offset on rows that the trees have not seen (Platt scaling)."""
    m = trees.margin(x)
    smooth = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    design = np.stack((m, np.ones_like(m)), 1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        hessian = (design * (p * (1 - p) + 1e-6)[:, None]).T @ design + 1e-3 * np.eye(2)
        theta += np.clip(np.linalg.solve(hessian, design.T @ (smooth - p)), -1, 1)
    trees.slope, trees.offset = float(max(theta[0], 1e-3)), float(theta[1])


def threshold_for(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold from which on held-out precision is at least ``precision``."""
    order = np.argsort(-probability, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.append(np.diff(probability[order]) < 0, True) if len(y) else np.zeros(0, bool)
    good = np.flatnonzero((right >= precision) & last)
    return float(probability[order][good[-1]]) if len(good) else 1.1
