"""Gradient-boosted trees for two classes, on binned features, in numpy. For bounded samples."""

from __future__ import annotations

import numpy as np

DEPTH = 4
TREES = 40
BINS = 32
RATE = 0.25
_RIDGE = 2.0

Boosted = dict[str, np.ndarray]


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Trees of one depth: in each level every node takes the split that gains most under the logistic loss."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(cut, x[:, k], side="left") for k, cut in enumerate(cuts)], axis=1)
    margin = np.zeros(len(y))
    inner = 2**DEPTH - 1
    features, thresholds, values = np.zeros((TREES, inner), np.int32), np.full((TREES, inner), np.inf, np.float32), np.zeros((TREES, 2**DEPTH), np.float32)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = weight * (y - p), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            count, first = 2**level, 2**level - 1
            best = np.full(count, 1e-6)
            choice, place = np.zeros(count, np.int64), np.full(count, -1)
            for k, cut in enumerate(cuts):
                if not len(cut):
                    continue
                slot = node * (BINS + 1) + binned[:, k]
                g = np.bincount(slot, gradient, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                h = np.bincount(slot, curve, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                gl, hl, ga, ha = g[:, : len(cut)], h[:, : len(cut)], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + _RIDGE) + (ga - gl) ** 2 / (ha - hl + _RIDGE) - ga**2 / (ha + _RIDGE)
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best
                best[better], choice[better], place[better] = gain[np.arange(count), at][better], k, at[better]
            split = np.flatnonzero(place >= 0)
            features[tree, first + split] = choice[split]
            thresholds[tree, first + split] = [cuts[choice[i]][place[i]] for i in split]
            right = (place[node] >= 0) & (binned[np.arange(len(y)), choice[node]] > place[node])
            node = 2 * node + right
        g, h = np.bincount(node, gradient, 2**DEPTH), np.bincount(node, curve, 2**DEPTH)
        values[tree] = RATE * g / (h + _RIDGE)
        margin += values[tree][node]
    return {"feature": features, "threshold": thresholds, "value": values}


def margins(model: Boosted, x: np.ndarray) -> np.ndarray:
    """Log odds of the rows of ``x``."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"]):
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            at = 2**level - 1 + node
            node = 2 * node + (x[rows, feature[at]] > threshold[at])
        total += value[node]
    return total
