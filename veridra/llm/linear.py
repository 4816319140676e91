"""Linear models over sparse rows, small enough for the driver: the number of training rows is bounded by the callers."""

from __future__ import annotations

import numpy as np


def svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss (dual coordinate descent). y is -1 or 1."""
    n, d = x.shape
    balance = {s: n / (2.0 * max(1, (y == s).sum())) for s in (-1, 1)}
    diagonal = np.array([1.0 / (2.0 * c * balance[int(s)]) for s in y])
    square = np.einsum("ij,ij->i", x, x).astype(float) + 1.0 + diagonal
    alpha, w, b = np.zeros(n), np.zeros(d), 0.0
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in order.permutation(n):
            g = y[i] * (float(x[i] @ w) + b) - 1.0 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - g / square[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w += step * x[i]
                b += step
                alpha[i] = new
    return w, float(b)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def logistic(
    row: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, d: int, decay: float = 1e-4, rounds: int = 150
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression over entries (row, col, value).

    Accelerated gradient descent; each weight has a step of its own, from the bound
    X'X <= diag(sum_i |x_ij| sum_k |x_ik|), so rare features move as fast as common ones.
    """
    n = len(y)
    size = np.bincount(row, np.abs(value), n) + 1.0
    curve = 0.25 * np.bincount(col, np.abs(value) * size[row], d) / n + decay
    curve_b = 0.25 * size.mean()
    w, b = np.zeros(d), 0.0
    v, vb, last, last_b = w.copy(), b, w.copy(), b
    for t in range(rounds):
        r = sigmoid(np.bincount(row, v[col] * value, n) + vb) - y
        w = v - (np.bincount(col, r[row] * value, d) / n + decay * v) / curve
        b = vb - r.mean() / curve_b
        m = t / (t + 3.0)
        v, vb = w + m * (w - last), b + m * (b - last_b)
        last, last_b = w, b
    return w, float(b)
