"""Follow-the-regularised-leader (proximal, per coordinate) with an elastic-net penalty, on sparse rows."""

from __future__ import annotations

import numpy as np


class Ftrl:
    """Weights of a linear model with ``classes`` outputs. The l1 part keeps a weight at exactly zero until its
    summed gradient is larger; the l2 part shrinks the others."""

    def __init__(self, size: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.1, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def step(self, rows: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        """One update of the given rows (whose weights are ``w``)."""
        n = self.n[rows]
        squared = gradient * gradient
        self.z[rows] += gradient - (np.sqrt(n + squared) - np.sqrt(n)) / self.alpha * w
        self.n[rows] = n + squared


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that minimises the log loss of softmax(scores / t), by golden-section search on log t.
    One more row, spread over the classes, stands for the error not seen yet (without it a separable set would
    ask for certainty)."""
    if not len(labels):
        return 1.0
    share = np.full(scores.shape, 1 / (len(labels) + 1) / scores.shape[1])
    share[np.arange(len(labels)), labels] += len(labels) / (len(labels) + 1)

    def loss(u: float) -> float:
        return -(share * np.log(np.maximum(softmax(scores / np.exp(u)), 1e-300))).sum(1).mean()

    a, b, g = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    c, d = b - g * (b - a), a + g * (b - a)
    while b - a > 1e-3:
        if loss(c) < loss(d):
            b, d = d, c
            c = b - g * (b - a)
        else:
            a, c = c, d
            d = a + g * (b - a)
    return float(np.exp((a + b) / 2))
