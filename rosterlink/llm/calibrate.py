"""A small ridge-regularised logistic fit for calibrating one or two raw features."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights, the intercept last, by damped Newton steps. ``x``: (rows, features); one class alone gives its smoothed rate."""
    y = np.asarray(y, float)
    x = np.asarray(x, float)
    x = np.column_stack([x.reshape(len(y), x.shape[1] if x.ndim > 1 else 1), np.ones(len(y))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    if not len(y) or y.min() == y.max():
        return w
    penalty = np.full(x.shape[1], ridge * len(y))
    penalty[-1] = 0

    def loss(v):
        z = x @ v
        return np.logaddexp(0, -z) @ y + np.logaddexp(0, z) @ (1 - y) + 0.5 * penalty @ v**2

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty + 1e-9), x.T @ (p - y) + penalty * w)
        size, here = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > here:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w

