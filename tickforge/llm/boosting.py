"""Gradient-boosted trees for two classes, and isotonic calibration; NumPy only.

Fits on a bounded sample of dense rows and predicts batches inside tasks.
"""

from __future__ import annotations

import numpy as np

BINS = 48


class Trees:
    """Complete binary trees of one depth: split feature and threshold per inner node, one value per leaf."""

    def __init__(self, start: float, depth: int, features: np.ndarray, cuts: np.ndarray, leaves: np.ndarray):
        self.start, self.depth = start, depth
        self.features, self.cuts, self.leaves = features, cuts, leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1 for each row."""
        total = np.full(len(x), self.start)
        flat = np.ascontiguousarray(x).ravel()
        base = np.arange(len(x)) * (x.shape[1] if x.ndim == 2 else 1)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (flat[base + feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.15, ridge: float = 1.0, least: float = 1.0
) -> Trees:
    """Newton boosting of the logistic loss over histograms of each feature.

    ``least`` is the smallest sum of second derivatives on a side of a split. Without rows or with one class
    the result has no trees and a constant margin.
    """
    n, width = x.shape
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    start = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    features, cuts, leaves = [], [], []
    if n == 0 or y.min() == y.max():
        empty = np.zeros((0, inner))
        return Trees(start, depth, empty.astype(np.int64), empty, np.zeros((0, 2**depth)))
    edges = []
    for j in range(width):
        e = np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]))
        values = np.unique(x[:, j])
        if len(values) <= BINS:
            e = (values[1:] + values[:-1]) / 2
        edges.append(e)
    codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(n, start)
    for _ in range(rounds):
        p = sigmoid(margin)
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.full(count, 1e-6)
            total_g = np.bincount(local, g, count)
            total_h = np.bincount(local, h, count)
            whole = total_g**2 / (total_h + ridge)
            for j in range(width):
                bins = len(edges[j]) + 1
                if bins < 2:
                    continue
                at = local * bins + codes[:, j]
                left_g = np.cumsum(np.bincount(at, g, count * bins).reshape(count, bins), axis=1)[:, :-1]
                left_h = np.cumsum(np.bincount(at, h, count * bins).reshape(count, bins), axis=1)[:, :-1]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - whole[:, None]
                gain[(left_h < least) | (right_h < least)] = 0
                pick = gain.argmax(axis=1)
                value = gain[np.arange(count), pick]
                better = value > best
                best[better] = value[better]
                feature[first : first + count][better] = j
                cut[first : first + count][better] = edges[j][pick[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        local = node - inner
        leaf_g, leaf_h = np.bincount(local, g, 2**depth), np.bincount(local, h, 2**depth)
        leaf = -rate * leaf_g / (leaf_h + ridge)
        margin += leaf[local]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Trees(start, depth, np.array(features), np.array(cuts), np.array(leaves))


class Isotonic:
    """Non-decreasing map from margin to probability, linear between the centres of pooled blocks."""

    def __init__(self, at: np.ndarray, value: np.ndarray):
        self.at, self.value = at, value

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return sigmoid(margin)
        # A small share of the raw score keeps the order inside flat blocks.
        return np.clip(0.98 * np.interp(margin, self.at, self.value) + 0.02 * sigmoid(margin), 0.0, 1.0)


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool-adjacent-violators; each block's mean is drawn by half a row towards the overall mean."""
    if len(y) == 0 or y.min() == y.max():
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, sum of margin
    for m, v in zip(margin[order], y[order], strict=True):
        blocks.append([1.0, float(v), float(m)])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, s, t = blocks.pop()
            blocks[-1][0] += w
            blocks[-1][1] += s
            blocks[-1][2] += t
    mean = float(y.mean())
    at = np.array([b[2] / b[0] for b in blocks])
    value = np.array([(b[1] + 0.5 * mean) / (b[0] + 0.5) for b in blocks])
    return Isotonic(at, np.maximum.accumulate(value))
