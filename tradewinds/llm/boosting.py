"""Small gradient-boosted trees for a few thousand rows: logistic loss, binned splits, fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Boosted:
    """Trees as full binary arrays: split feature, threshold, leaf value."""

    base: float
    rate: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            out += self.rate * v[node - (2**self.depth - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x)) if len(x) else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> Boosted:
    """Second-order boosting; every level of a tree splits each node by its best gain."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    trees = []
    for _ in range(rounds):
        p = sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            total_g, total_h = np.bincount(local, g, width), np.bincount(local, h, width)
            for j in range(d):
                if not len(edges[j]):
                    continue
                slots = len(edges[j]) + 1
                at = local * slots + binned[:, j]
                lg = np.cumsum(np.bincount(at, g, width * slots).reshape(width, slots), 1)[:, :-1]
                lh = np.cumsum(np.bincount(at, h, width * slots).reshape(width, slots), 1)[:, :-1]
                rg, rh = total_g[:, None] - lg, total_h[:, None] - lh
                gain = lg**2 / (lh + l2) + rg**2 / (rh + l2) - (total_g**2 / (total_h + l2))[:, None]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = j
                cut[first : first + width][better] = edges[j][k[better]]
            f, c = feature[node], cut[node]
            node = 2 * node + 1 + (x[np.arange(n), f] > c)
        where = node - inner
        leaf = -np.bincount(where, g, leaves) / (np.bincount(where, h, leaves) + l2)
        margin += rate * leaf[where]
        trees.append((feature, cut, leaf))
    return Boosted(base, rate, depth, *(np.stack(t) for t in zip(*trees, strict=True)))
