"""Histogram gradient-boosted trees and isotonic calibration, in numpy.

Training bins each feature by quantiles and grows trees level by level from gradient histograms
(logistic loss). A model is flat arrays, a row per tree in heap order, so that scoring walks all
documents of a batch down all levels at once.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Model(NamedTuple):
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # go right if the value is above
    leaf: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - len(cut)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: float = 3.0) -> Model:
    """least: the smallest hessian sum of a child is least / 4. With one class only, or no rows, a constant."""
    y = np.asarray(y, np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), base)
    f = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for k in range(f)]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    slot = binned + np.arange(f) * bins
    features, thresholds, leaves, margin = [], [], [], np.full(len(y), base)
    rows = np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut, at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf), np.full(2**depth - 1, bins)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            place = ((node - first)[:, None] * (f * bins) + slot).ravel()
            sums = [np.bincount(place, np.repeat(w, f), n * f * bins).reshape(n, f, bins).cumsum(axis=2) for w in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :1, -1:] for s in sums)
            gr, hr = gt - gl, ht - hl
            gain = gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - gt**2 / (ht + penalty)
            gain[(hl < least / 4) | (hr < least / 4)] = 0
            best = gain.reshape(n, -1).argmax(axis=1)
            for k in np.flatnonzero(gain.reshape(n, -1).max(axis=1) > 1e-9):
                j, b = divmod(int(best[k]), bins)
                if b < len(cuts[j]):
                    feature[first + k], cut[first + k], at[first + k] = j, cuts[j][b], b
            node = 2 * node + 1 + (binned[rows, feature[node]] > at[node])
        own = node - (2**depth - 1)
        leaf = -rate * np.bincount(own, g, 2**depth) / (np.bincount(own, h, 2**depth) + penalty)
        margin += leaf[own]
        features.append(feature), thresholds.append(cut), leaves.append(leaf)
    return Model(np.array(features), np.array(thresholds), np.array(leaves), base)


class Isotonic(NamedTuple):
    """A rising piecewise-linear map."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, p: np.ndarray) -> np.ndarray:
        """Ties that the map makes keep the order of p by a thousandth."""
        return np.clip(0.999 * np.interp(p, self.x, self.y) + 0.001 * p, 0, 1)


def isotonic(p: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; each pool counts half a case of either label more, so no score is exactly 0 or 1."""
    if len(p) == 0:
        return Isotonic(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    order = np.argsort(p, kind="stable")
    pools: list[list[float]] = []  # sum of labels, count, first and last p
    for q, label in zip(p[order].tolist(), np.asarray(y, np.float64)[order].tolist(), strict=True):
        pools.append([label, 1, q, q])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            s, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], last]
    xs, ys = [], []
    for s, n, a, b in pools:
        xs += [a, b] if b > a else [a]
        ys += [(s + 0.5) / (n + 1)] * (2 if b > a else 1)
    return Isotonic(np.array(xs), np.maximum.accumulate(np.array(ys)))
