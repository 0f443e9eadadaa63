"""Follow-the-regularised-leader with elastic-net penalties for sparse rows (numpy, driver-size samples)."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Multinomial logistic regression; coordinates below the l1 threshold have weight zero."""

    def __init__(self, features: int, classes: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, index=slice(None)) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, seed: int = 0) -> Ftrl:
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for r in rng.permutation(len(rows)).tolist():
                index, value = rows[r]
                w = self.weights(index)
                p = softmax(value @ w)
                p[labels[r]] -= 1.0
                g = value[:, None] * p
                n = self.n[index]
                after = n + g * g
                self.z[index] += g - (np.sqrt(after) - np.sqrt(n)) / self.alpha * w
                self.n[index] = after
        return self


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)
