"""A small gradient-boosted classifier in numpy: logistic loss, trees of depth two, cuts at quantiles."""

from __future__ import annotations

import numpy as np


class Boost:
    def __init__(self, trees: int = 40, rate: float = 0.3, cuts: int = 24):
        self.trees, self.rate, self.cuts = trees, rate, cuts
        self.base, self.nodes = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boost":
        x, y = np.asarray(x, float), np.asarray(y, float)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        f = np.full(len(y), self.base)
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, self.cuts))) for j in range(x.shape[1])]
        for _ in range(self.trees):
            q = 1 / (1 + np.exp(-f))
            g, h = y - q, np.maximum(q * (1 - q), 1e-6)
            top = self._cut(x, g, h, edges, np.ones(len(y), bool))
            if top is None:
                break
            j, t = top
            left = x[:, j] <= t
            node = [j, t]
            for side in (left, ~left):
                sub = self._cut(x, g, h, edges, side)
                if sub is None:
                    node.append((None, 0.0, self._leaf(g, h, side), 0.0))
                else:
                    a = side & (x[:, sub[0]] <= sub[1])
                    node.append((sub[0], sub[1], self._leaf(g, h, a), self._leaf(g, h, side & ~a)))
            self.nodes.append(node)
            f += self.rate * self._one(node, x)
        return self

    @staticmethod
    def _leaf(g: np.ndarray, h: np.ndarray, m: np.ndarray) -> float:
        return float(np.clip(g[m].sum() / (h[m].sum() + 1.0), -4, 4))

    @staticmethod
    def _cut(x, g, h, edges, m):
        best, at = 1e-6, None
        gs, hs = g[m].sum(), h[m].sum()
        for j, e in enumerate(edges):
            if not len(e):
                continue
            b = np.searchsorted(e, x[m, j])
            gl = np.cumsum(np.bincount(b, g[m], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[m], len(e) + 1))[:-1]
            gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, at = gain[k], (j, e[k])
        return at

    @staticmethod
    def _one(node, x: np.ndarray) -> np.ndarray:
        j, t, *sides = node
        out = np.zeros(len(x))
        for side, m in zip(sides, (x[:, j] <= t, x[:, j] > t)):
            k, u, a, b = side
            out[m] = a if k is None else np.where(x[m, k] <= u, a, b)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities."""
        x = np.asarray(x, float)
        f = np.full(len(x), self.base)
        for node in self.nodes:
            f += self.rate * self._one(node, x)
        return 1 / (1 + np.exp(-f))
