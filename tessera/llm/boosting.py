"""Histogram gradient-boosted trees in numpy, flattened into arrays for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """``depth`` levels of complete trees: node k of a tree has the children 2k+1 and 2k+2.

    ``feature`` and ``threshold`` are (trees, inner nodes); a row goes right where its value is above
    the threshold. ``leaf`` is (trees, leaves); ``base`` is the score before any tree.
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**self.depth - 1)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: int = 5) -> Forest:
    """Second-order boosting of the log loss; splits are chosen from per-node histograms of gradients."""
    n, f = x.shape
    mean = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base, depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(f)], axis=1)
    flat = binned + bins * np.arange(f)
    cuts = np.full((f, bins), np.inf)
    for j, e in enumerate(edges):
        cuts[j, : len(e)] = e
    score = np.full(n, base)
    out_f, out_t, out_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            keys = (local[:, None] * (f * bins) + flat).ravel()
            size = width * f * bins
            hist = [np.bincount(keys, np.repeat(w, f) if w is not None else None, size).reshape(width, f, bins) for w in (g, h, None)]
            gl, hl, nl = (a.cumsum(axis=2) for a in hist)
            gt, ht, nt = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(nl < least) | (nt - nl < least) | ~np.isfinite(cuts)[None]] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            feature[first : first + width] = np.where(good, best // bins, 0)
            threshold[first : first + width] = np.where(good, cuts[best // bins, best % bins], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        local = node - inner
        value = rate * np.bincount(local, g, leaves) / (np.bincount(local, h, leaves) + l2)
        score += value[local]
        out_f.append(feature)
        out_t.append(threshold)
        out_v.append(value)
    return Forest(np.array(out_f), np.array(out_t), np.array(out_v), base, depth)
