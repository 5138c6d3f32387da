"""Small gradient-boosted trees of depth two with logistic loss, trained on a bounded sample."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Sum of trees; each splits on one feature and then on one in either half."""

    def __init__(self, rounds: int = 40, rate: float = 0.3, bins: int = 16):
        self.rounds, self.rate, self.bins = rounds, rate, bins
        self.start, self.trees = 0.0, []

    def _split(self, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
        best = (-1.0, 0, 0.0)
        for f in range(x.shape[1]):
            for t in self.cuts[f]:
                left = x[:, f] <= t
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g.sum() - gl, h.sum() - hl
                if hl < 1 or hr < 1:
                    continue
                gain = gl * gl / (hl + 1) + gr * gr / (hr + 1)
                if gain > best[0]:
                    best = (gain, f, float(t))
        return best[1], best[2]

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        z = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = y - p, p * (1 - p) + 1e-6
            f, t = self._split(x, g, h)
            tree, left = [], x[:, f] <= t
            for side in (left, ~left):
                if side.sum() < 4:
                    tree.append((0, np.inf, self._leaf(g[side], h[side]), 0.0))
                    continue
                f2, t2 = self._split(x[side], g[side], h[side])
                low = side & (x[:, f2] <= t2)
                high = side & ~low
                tree.append((f2, t2, self._leaf(g[low], h[low]), self._leaf(g[high], h[high])))
            self.trees.append((f, t, tree))
            z += self._tree(x, self.trees[-1])
        return self

    def _leaf(self, g: np.ndarray, h: np.ndarray) -> float:
        return float(self.rate * g.sum() / (h.sum() + 1))

    @staticmethod
    def _tree(x: np.ndarray, tree: tuple) -> np.ndarray:
        f, t, halves = tree
        out = [np.where(x[:, f2] <= t2, a, b) for f2, t2, a, b in halves]
        return np.where(x[:, f] <= t, *out)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for tree in self.trees:
            z = z + self._tree(x, tree)
        return 1 / (1 + np.exp(-z))
