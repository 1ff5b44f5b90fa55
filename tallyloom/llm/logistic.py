"""Small dense logistic regression, fitted on a bounded sample of rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Logistic:
    """Log odds = intercept + (x - mean) / scale . weights; `base` is the log odds of the label in the sample."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    intercept: float
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.intercept


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> Logistic:
    """Ridge-penalised maximum likelihood by Newton steps; the intercept is free.

    Without rows of both labels the weights are zero and the odds are those of the labels, one row of each added.
    """
    rows, width = x.shape
    base = float(np.log((y.sum() + 1) / (rows - y.sum() + 1)))
    if rows == 0 or y.min() == y.max():
        return Logistic(np.zeros(width), np.ones(width), np.zeros(width), base, base)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([np.ones((rows, 1)), (x - mean) / scale])
    penalty = np.full(width + 1, ridge * rows)
    penalty[0] = 1e-9
    w = np.zeros(width + 1)
    w[0] = base
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        change = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return Logistic(mean, scale, w[1:], float(w[0]), base)
