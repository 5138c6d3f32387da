"""Logistic regression on hashed binary features, trained on a bounded sample."""

from __future__ import annotations

import numpy as np


def fit(rows: list[np.ndarray], labels: np.ndarray, dims: int, epochs: int = 40, rate: float = 0.5, ridge: float = 1e-4, seed: int = 7) -> np.ndarray:
    """Weights (the last is the bias) by AdaGrad over the sample; each row holds the indices that are 1."""
    w, g2 = np.zeros(dims + 1), np.full(dims + 1, 1e-6)
    rng = np.random.default_rng(seed)
    n_pos = max(1, int(labels.sum()))
    weight = np.where(labels > 0, len(labels) / (2 * n_pos), len(labels) / (2 * max(1, len(labels) - n_pos)))
    for _ in range(epochs):
        for block in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 64)):
            idx = np.concatenate([rows[i] for i in block])
            owner = np.repeat(np.arange(len(block)), [len(rows[i]) for i in block])
            z = np.bincount(owner, w[idx], minlength=len(block)) + w[dims]
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[block]) * weight[block]
            grad = np.bincount(idx, err[owner], minlength=dims + 1)
            grad[dims] = err.sum()
            touched = np.flatnonzero(grad)
            gr = grad[touched] / len(block) + ridge * w[touched]
            g2[touched] += gr * gr
            w[touched] -= rate * gr / np.sqrt(g2[touched])
    return w


def score(rows: list[np.ndarray], w: np.ndarray) -> np.ndarray:
    """Probability of each row."""
    if not rows:
        return np.zeros(0)
    size = np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows)), size)
    z = np.bincount(owner, w[np.concatenate(rows)], minlength=len(rows)) + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
