"""Gradient-boosted trees in numpy: histogram splits, logistic loss, monotonic constraints, flattened nodes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees as node arrays: a leaf has feature -1 and points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows walk a tree together, level by level."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                inner = self.feature[at] >= 0
                goes_left = rows[every, np.maximum(self.feature[at], 0)] <= self.threshold[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            total += self.value[at]
        return 1.0 / (1.0 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Bin limits between different values, at quantiles."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _best_split(g, h, binned, rows, edges, monotone, low, high, smooth, least):
    """(gain, feature, bin) of the best allowed split of `rows`, or None."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    parent = total_g**2 / (total_h + smooth)
    best = None
    for f, limits in enumerate(edges):
        if not len(limits):
            continue
        n = len(limits) + 1
        own = binned[rows, f]
        gl = np.cumsum(np.bincount(own, g[rows], n))[:-1]
        hl = np.cumsum(np.bincount(own, h[rows], n))[:-1]
        gr, hr = total_g - gl, total_h - hl
        vl = np.clip(-gl / (hl + smooth), low, high)
        vr = np.clip(-gr / (hr + smooth), low, high)
        gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - parent
        allowed = (hl >= least) & (hr >= least)
        if monotone[f]:
            allowed &= monotone[f] * (vr - vl) >= 0
        gain = np.where(allowed, gain, -1.0)
        at = int(np.argmax(gain))
        if gain[at] > 1e-9 and (best is None or gain[at] > best[0]):
            best = (gain[at], f, at, vl[at], vr[at])
    return best


def fit(x: np.ndarray, y: np.ndarray, monotone: list[int], trees=60, depth=3, rate=0.2, bins=48, smooth=1.0, least=3.0) -> Forest:
    """Fit on rows `x` with labels `y` in 0, 1. `monotone`: +1, -1 or 0 for each feature.

    Constant labels or no rows give a forest without trees, whose score is the smoothed rate of label 1.
    """
    rate_1 = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(rate_1 / (1.0 - rate_1)))
    nodes, roots = [], []
    if len(y) and 0 < y.sum() < len(y):
        edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-margin))
            g, h = p - y, p * (1.0 - p)

            def grow(rows, level, low, high):
                me = len(nodes)
                value = float(np.clip(-g[rows].sum() / (h[rows].sum() + smooth), low, high)) * rate
                nodes.append([-1, 0.0, me, me, value])
                split = level < depth and _best_split(g, h, binned, rows, edges, monotone, low, high, smooth, least)
                if not split:
                    margin[rows] += value
                    return me
                _, f, at, vl, vr = split
                middle = (vl + vr) / 2  # children of a constrained split stay on their side of it
                goes_left = binned[rows, f] <= at
                left_range, right_range = (low, high), (low, high)
                if monotone[f] > 0:
                    left_range, right_range = (low, middle), (middle, high)
                elif monotone[f] < 0:
                    left_range, right_range = (middle, high), (low, middle)
                left = grow(rows[goes_left], level + 1, *left_range)
                right = grow(rows[~goes_left], level + 1, *right_range)
                nodes[me] = [f, float(edges[f][at]), left, right, 0.0]
                return me

            roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    columns = list(zip(*nodes, strict=True)) if nodes else [[], [], [], [], []]
    kinds = (np.int64, float, np.int64, np.int64, float)
    arrays = [np.array(c, dtype=k) for c, k in zip(columns, kinds, strict=True)]
    return Forest(*arrays, np.array(roots, dtype=np.int64), depth, base)
