"""Linear models on sparse rows, fitted on a bounded sample in one process; scoring them is the Spark job.

A row is a pair (indices, values). All fits are deterministic: the order of examples comes from a fixed seed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Row = tuple[np.ndarray, np.ndarray]


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader, proximal form, per coordinate; elastic net by ``l1`` and ``l2``.

    Weights are (size, outputs). The last index of every row should be a bias feature if one is wanted.
    """

    def __init__(self, size: int, outputs: int, alpha: float, beta: float, l1: float, l2: float):
        self.z = np.zeros((size, outputs))
        self.n = np.zeros((size, outputs))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def at(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def step(self, index: np.ndarray, gradient: np.ndarray, weights: np.ndarray) -> None:
        """One update; ``index`` holds no index twice."""
        n = self.n[index]
        after = n + gradient * gradient
        self.z[index] += gradient - (np.sqrt(after) - np.sqrt(n)) / self.alpha * weights
        self.n[index] = after

    def weights(self) -> np.ndarray:
        return self.at(np.arange(len(self.z)))


def fit_multinomial(
    rows: Sequence[Row], labels: np.ndarray, size: int, classes: int, epochs: int = 3,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01,
) -> np.ndarray:
    """Sparse multinomial logistic regression: weights (size, classes)."""
    model, rng = Ftrl(size, classes, alpha, beta, l1, l2), np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, x = rows[i]
            w = model.at(index)
            p = softmax(x @ w)
            p[labels[i]] -= 1.0
            model.step(index, x[:, None] * p[None, :], w)
    return model.weights()


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """Temperature (0.05 to 20) that minimises the log loss of ``softmax(scores / t)``, by golden section."""
    if not len(scores):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(scores / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).sum()

    a, b, g = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit_paired_logistic(
    rows: Sequence[Row], swapped: Sequence[Row | None], labels: np.ndarray, size: int, penalty: float,
    positive_weight: float = 1.0, epochs: int = 6, alpha: float = 0.3, beta: float = 1.0, l1: float = 1.5, l2: float = 0.1,
) -> np.ndarray:
    """Binary logistic regression whose loss adds ``penalty * (score(row) - score(swapped row)) ** 2``."""
    model, rng = Ftrl(size, 1, alpha, beta, l1, l2), np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, x = rows[i]
            other = swapped[i]
            if other is None:
                w = model.at(index)
                weight = positive_weight if labels[i] else 1.0
                g = weight * (sigmoid(x @ w[:, 0]) - labels[i])
                model.step(index, (x * g)[:, None], w)
                continue
            both = np.union1d(index, other[0])
            a, b = np.zeros(len(both)), np.zeros(len(both))
            a[np.searchsorted(both, index)] = x
            b[np.searchsorted(both, other[0])] = other[1]
            w = model.at(both)
            za, zb = a @ w[:, 0], b @ w[:, 0]
            weight = positive_weight if labels[i] else 1.0
            g = weight * (sigmoid(za) - labels[i]) * a + 2.0 * penalty * (za - zb) * (a - b)
            model.step(both, g[:, None], w)
    return model.weights()[:, 0]


def fit_hinge(rows: Sequence[Row], signs: np.ndarray, size: int, cost: np.ndarray, epochs: int = 12) -> np.ndarray:
    """L2-regularised squared-hinge model by dual coordinate descent; ``cost`` is C of each example."""
    w, a, rng = np.zeros(size), np.zeros(len(rows)), np.random.default_rng(0)
    diagonal = np.array([x @ x for _, x in rows]) + 0.5 / cost
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            index, x = rows[i]
            g = signs[i] * (x @ w[index]) - 1.0 + a[i] * 0.5 / cost[i]
            new = max(a[i] - g / diagonal[i], 0.0)
            if new != a[i]:
                w[index] += (new - a[i]) * signs[i] * x
                moved = max(moved, abs(new - a[i]))
                a[i] = new
        if moved < 1e-4:
            break
    return w


def fit_platt(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of ``sigmoid(slope * score + offset)``, by Newton steps with smoothed targets."""
    pos, neg = (labels == 1).sum(), (labels == 0).sum()
    if not len(scores):
        return 1.0, 0.0
    scale = max(float(np.std(scores)), 1e-9)
    s = scores / scale
    t = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(50):
        p = sigmoid(a * s + b)
        v, d = np.maximum(p * (1 - p), 1e-9), p - t
        h = np.array([[(v * s * s).sum() + 1e-3, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-9]])
        da, db = np.linalg.solve(h, [(d * s).sum() + 1e-3 * a, d.sum()])
        step = min(1.0, 5.0 / max(abs(da), abs(db), 1e-12))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-7:
            break
    return float(max(a, 0.0) / scale), float(b)
