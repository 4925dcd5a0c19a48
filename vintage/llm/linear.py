"""Logistic regression on the driver's bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Design:
    """Rows of binary features (numbers at[ends[i-1]:ends[i]]) and of dense columns beside them."""

    at: np.ndarray
    ends: np.ndarray
    features: int
    dense: np.ndarray

    @classmethod
    def of(cls, rows: list[list[int]], features: int, dense: np.ndarray | None = None) -> Design:
        ends = np.cumsum([len(r) for r in rows]).astype(np.int64)
        at = np.array([f for r in rows for f in r], np.int64)
        return cls(at, ends, features, np.zeros((len(rows), 0)) if dense is None else dense)

    def __len__(self) -> int:
        return len(self.ends)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.ends, prepend=0))

    def take(self, keep: np.ndarray) -> Design:
        own = keep[self.rows()]
        return Design(self.at[own], np.cumsum(np.diff(self.ends, prepend=0)[keep]), self.features, self.dense[keep])

    def with_dense(self, dense: np.ndarray) -> Design:
        return Design(self.at, self.ends, self.features, dense)

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = self.dense @ w[self.features :]
        return out + np.bincount(self.rows(), w[self.at], len(self)) if len(self.at) else out

    def t_dot(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.at, v[self.rows()], self.features), self.dense.T @ v])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def logistic(x: Design, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-4, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by full gradients with Adam's steps; the same rows give the same weights.

    With one class only, or no rows, weights are zero and the bias says the (smoothed) share.
    """
    weight = np.ones(len(y)) if weight is None else weight
    total = weight.sum()
    share = (float((weight * y).sum()) + 0.5) / (float(total) + 1)
    w, bias = np.zeros(x.features + x.dense.shape[1]), float(logit(np.array(share)))
    if not len(y) or y.min() == y.max():
        return w, bias
    m = v = np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        err = weight * (sigmoid(x.dot(w) + bias) - y) / total
        g = np.append(x.t_dot(err) + l2 * w, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)
