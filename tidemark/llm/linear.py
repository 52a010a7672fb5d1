"""Small linear models: logistic regression by Newton steps, and score measures."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def with_constant(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (the last one is the constant) that minimise log loss plus penalty/2 x squared weights.

    With one class only, all weights are zero but the constant, which stays finite.
    """
    x = with_constant(x)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + ridge @ (w * w) / 2)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and (new := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - new < 1e-7 * max(1.0, now):
            break
        w, now = w - size * step, new
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    """The chance that a positive scores above a negative; ties count half. 0.5 if a class is missing."""
    order = np.argsort(scores, kind="stable")
    values, first = np.unique(scores[order], return_index=True)
    ends = np.append(first[1:], len(scores))
    ranks = np.empty(len(scores))
    ranks[order] = np.repeat((first + ends - 1) / 2 + 1, ends - first)
    n1 = int(labels.sum())
    n0 = len(labels) - n1
    return float((ranks[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)) if n1 and n0 else 0.5
