"""Logistic regression on a sample of bounded size, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Logistic:
    weights: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x))


def fit(x: np.ndarray, y: np.ndarray, l2: float = 0.01, steps: int = 200) -> Logistic:
    """Accelerated gradient descent on the mean loss; columns are scaled to unit deviation
    for it. With one class only, the model gives that class's smoothed share."""
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, share = len(y), (np.sum(y) + 0.5) / (len(y) + 1)
    rest = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max() or not x.shape[1]:
        return Logistic(np.zeros(x.shape[1]), rest)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = np.inf  # a constant column says nothing
    z = (x - centre) / scale
    v = np.ones(z.shape[1]) / np.sqrt(z.shape[1])
    for _ in range(10):
        v = z.T @ (z @ v)
        top = np.linalg.norm(v)
        v /= max(top, 1e-12)
    rate = 1 / (0.25 * max(1.1 * top / n, 1) + l2)
    w, b = np.zeros(z.shape[1]), rest
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(steps):
        error = sigmoid(z @ ahead_w + ahead_b) - y
        new_w, new_b = ahead_w - rate * (z.T @ error / n + l2 * ahead_w), ahead_b - rate * error.mean()
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w, ahead_b = new_w + (t - 1) / grown * (new_w - w), new_b + (t - 1) / grown * (new_b - b)
        w, b, t = new_w, new_b, grown
    w = w / scale
    return Logistic(w, float(b - centre @ w))


def calibrate(logit: np.ndarray, y: np.ndarray) -> Logistic:
    """Platt scaling: a probability from a logit, on rows that its model has not seen."""
    return fit(np.asarray(logit).reshape(-1, 1), y, l2=1e-3)


def folds(n: int, k: int, seed: int) -> np.ndarray:
    """A fold of each of ``n`` rows, the same for the same rows in order."""
    return np.random.Generator(np.random.PCG64(seed)).permutation(n) % k
