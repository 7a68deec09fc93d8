"""Gradient-boosted trees for log loss over small tables of ordinal features."""

from __future__ import annotations

import numpy as np


class Trees:
    """Depth-limited regression trees on the gradient of log loss, with Newton leaves."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, penalty: float = 1.0):
        self.rounds, self.depth, self.rate, self.penalty = rounds, depth, rate, penalty
        self.base, self.trees = 0.0, []
        self.scale = (1.0, 0.0)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        """x: rows by features, integers of a small range; y: 0 or 1."""
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(x, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            margin += self.rate * self._values(tree, x)
        return self

    def _grow(self, x, gradient, curvature, rows, depth):
        g, h = gradient[rows].sum(), curvature[rows].sum()
        leaf = float(g / (h + self.penalty))
        if depth == 0 or len(rows) < 8:
            return leaf
        best, chosen = 1e-6, None
        for f in range(x.shape[1]):
            column = x[rows, f]
            top = int(column.max()) + 1
            if top == 1:
                continue
            left_g = np.cumsum(np.bincount(column, gradient[rows], top))[:-1]
            left_h = np.cumsum(np.bincount(column, curvature[rows], top))[:-1]
            gain = left_g**2 / (left_h + self.penalty) + (g - left_g) ** 2 / (h - left_h + self.penalty) - g**2 / (h + self.penalty)
            at = int(gain.argmax())
            if gain[at] > best:
                best, chosen = gain[at], (f, at)
        if chosen is None:
            return leaf
        f, at = chosen
        low = x[rows, f] <= at
        return (f, at, self._grow(x, gradient, curvature, rows[low], depth - 1), self._grow(x, gradient, curvature, rows[~low], depth - 1))

    def _values(self, tree, x):
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, at, low, high = tree
        return np.where(x[:, f] <= at, self._values(low, x), self._values(high, x))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self.rate * self._values(tree, x)
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        """Platt scaling on rows that the trees were not grown on."""
        self.scale = platt(self.margin(x), y)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * self.margin(x) + b)))


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to the share of ones (Newton steps)."""
    ones, zeros = float(y.sum()), float(len(y) - y.sum())
    if not ones or not zeros:
        return 1.0, 0.0
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0 / max(float(np.std(margin)), 1e-6), float(np.log(ones / zeros))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -35, 35)))
        d, w = target - p, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float((d * margin).sum()) - 1e-3 * a, float(d.sum())
        haa, hab, hbb = float((w * margin * margin).sum()) + 1e-3, float((w * margin).sum()), float(w.sum()) + 1e-9
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da) / 2, abs(db) / 2)
        a, b = a + da / size, b + db / size
        if abs(da) + abs(db) < 1e-7:
            break
    return float(a), float(b)
