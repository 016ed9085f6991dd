"""Small fits on bounded samples, in numpy."""

from __future__ import annotations

import numpy as np


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Intercept and weights of a ridge-penalised logistic regression, by Newton's method on standardised columns."""
    if not len(y) or y.min() == y.max():
        return np.zeros(x.shape[1] + 1) if not len(y) else np.concatenate([[3.0 if y[0] else -3.0], np.zeros(x.shape[1])])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    ridge = penalty * len(y) * np.eye(len(w))
    ridge[0, 0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = w[1:] / scale
    return np.concatenate([[w[0] - mean @ slopes], slopes])
