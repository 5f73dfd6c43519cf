"""A small linear support vector machine, trained on a bounded sample that the caller has gathered."""

from __future__ import annotations

import numpy as np


def train_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the weighted squared hinge loss plus ``penalty`` times the squared norm.

    Accelerated gradient steps of a size that the data's largest singular value allows, so the result is the same in every run.
    """
    y = np.asarray(y, dtype=np.float64)
    weight = np.ones(len(y)) if weight is None else np.asarray(weight, dtype=np.float64)
    weight = weight / weight.sum()

    # ``x`` is used as it is, in its own precision, and never copied: it is the largest thing here.
    def times(w: np.ndarray) -> np.ndarray:
        return x @ w[:-1].astype(x.dtype) + w[-1]

    def back(v: np.ndarray) -> np.ndarray:
        return np.append((v.astype(x.dtype) @ x).astype(np.float64), v.sum())

    direction = np.ones(x.shape[1] + 1)
    for _ in range(20):
        direction = back(weight * times(direction))
        direction /= np.linalg.norm(direction) or 1.0
    size = 1.0 / (2.2 * float((weight * times(direction) ** 2).sum()) + 2 * penalty)
    ridge = np.full(x.shape[1] + 1, penalty)
    ridge[-1] = 0
    now = ahead = np.zeros(x.shape[1] + 1)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * times(ahead))
        new = ahead - size * (-2 * back(weight * y * slack) + 2 * ridge * ahead)
        ahead = new + k / (k + 3) * (new - now)
        now = new
    return now[:-1], float(now[-1])


def train_sigmoid(x: np.ndarray, y: np.ndarray, steps: int = 50, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic weights and offset by damped Newton steps, for turning margins into probabilities."""
    design = np.hstack([np.asarray(x, dtype=np.float64), np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) / len(y) + penalty * w
        curve = (design.T * (p * (1 - p) / len(y))) @ design + penalty * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])
