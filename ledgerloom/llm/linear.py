"""Logistic regression on sparse rows, for bounded training samples on the driver."""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest


class Rows:
    """Sparse rows: ids of features and their values, row after row."""

    def __init__(self, ids: list[np.ndarray], values: list[np.ndarray] | None, width: int):
        self.sizes = np.array([len(x) for x in ids], np.int64)
        self.ids = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
        self.values = np.ones(len(self.ids)) if values is None else np.concatenate([*values, np.zeros(0)])
        self.row = np.repeat(np.arange(len(ids)), self.sizes)
        self.n, self.width = len(ids), width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.ids] * self.values, self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, g[self.row] * self.values, self.width)

    def take(self, rows: np.ndarray) -> Rows:
        out, keep = object.__new__(Rows), np.isin(self.row, rows)
        place = np.zeros(self.n, np.int64)
        place[rows] = np.arange(len(rows))
        out.ids, out.values, out.row, out.n, out.width = self.ids[keep], self.values[keep], place[self.row[keep]], len(rows), self.width
        return out

    def only(self, columns: np.ndarray) -> Rows:
        """Without the features that the mask lacks."""
        out, keep = object.__new__(Rows), columns[self.ids]
        out.ids, out.values, out.row, out.n, out.width = self.ids[keep], self.values[keep], self.row[keep], self.n, self.width
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Rows, dense: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 100, rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """(weights of sparse features, weights of the dense columns and the bias); y holds probabilities. Adam on the whole sample, no randomness."""
    dense = np.column_stack([dense, np.ones(x.n)])
    w, v = np.zeros(x.width), np.zeros(dense.shape[1])
    m, s = np.zeros(len(w) + len(v)), np.zeros(len(w) + len(v))
    for t in range(1, steps + 1):
        g = (sigmoid(x.dot(w) + dense @ v) - y) / max(1, x.n)
        grad = np.concatenate([x.back(g) + l2 * w, dense.T @ g])
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        step = rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-9)
        w -= step[: len(w)]
        v -= step[len(w) :]
    return w, v


def feature_hash(feature: bytes, bits: int) -> int:
    return xxh3_64_intdigest(feature) & ((1 << bits) - 1)
