"""Gradient-boosted trees for two classes, in numpy, with Platt-calibrated scores. Small, deterministic, no sampling."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth on quantile bins; each is four arrays in heap order, so that scoring is a few gathers."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 5.0):
        self.n_trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], 1)
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(p / (1 - p)))
        self.trees, score = [], np.full(len(y), self.start)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._leaf(tree, x)
        return self

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = 2**self.depth - 1
        feature, cut, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**self.depth)
        node = np.zeros(len(gradient), np.int64)
        for i in range(inner):
            here = np.flatnonzero(node == i)
            best = (1e-9, 0, np.inf, 0)
            for k, cuts in enumerate(self.cuts):
                if not len(cuts) or not len(here):
                    continue
                g = np.cumsum(np.bincount(binned[here, k], gradient[here], len(cuts) + 1))
                h = np.cumsum(np.bincount(binned[here, k], hessian[here], len(cuts) + 1))
                left, right = h[:-1], h[-1] - h[:-1]
                gain = g[:-1] ** 2 / (left + 1) + (g[-1] - g[:-1]) ** 2 / (right + 1) - g[-1] ** 2 / (h[-1] + 1)
                gain[(left < self.least * 0.05) | (right < self.least * 0.05)] = 0
                b = int(gain.argmax())
                if gain[b] > best[0]:
                    best = (gain[b], k, cuts[b], b)
            feature[i], cut[i] = best[1], best[2]
            goes = binned[here, best[1]] > best[3] if best[2] < np.inf else np.zeros(len(here), bool)
            node[here] = 2 * i + 1 + goes
        for leaf in range(2**self.depth):
            here = node == leaf + inner
            value[leaf] = self.rate * gradient[here].sum() / (hessian[here].sum() + 1)
        return feature, cut, value

    def _leaf(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, every = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[every, feature[node]] >= cut[node])
        return value[node - len(feature)]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum(self._leaf(t, x) for t in self.trees)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Fits sigmoid(a * raw + b) to rows that the trees were not grown on, by Newton steps on smoothed targets."""
        raw, n1 = self.raw(x), y.sum()
        target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * raw + b)))
            w, e = p * (1 - p) + 1e-9, p - target
            gradient = np.array([(e * raw).sum() + 1e-3 * (a - 1), e.sum()])
            hessian = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
            a, b = np.array([a, b]) - np.linalg.solve(hessian, gradient)
        self.a, self.b = float(a), float(b)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * self.raw(x) + self.b)))
