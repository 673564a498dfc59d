"""Gradient-boosted trees in numpy, with features the score may only rise or fall in.

Trees are complete and of one depth, so a forest is four arrays and scoring is
the same few array steps for all rows and trees at once. A node that is not worth
splitting passes all rows to the left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """``feature`` and ``threshold`` per tree and inner node (children of ``i`` are ``2i+1`` and ``2i+2``),
    ``value`` per tree and leaf, all in log odds beside ``start``."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for every row of ``x``."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), 1 / (1 + np.exp(-self.start)))
        rows, all_trees = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[all_trees, node]] > self.threshold[all_trees, node]
            node = 2 * node + 1 + right
        total = self.start + self.value[all_trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cut points between distinct values, at most ``bins - 1`` a feature, at quantiles."""
    out = []
    for column in x.T:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if len(column) else column
        out.append(values)
    return out


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
        bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Forest:
    """Fit log odds of ``y`` (0 or 1). ``monotone`` has 1, -1 or 0 per feature: the score never falls
    (rises) when that feature rises. Without both labels the forest is a constant."""
    inner = (1 << depth) - 1
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Forest(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = _edges(x, bins)
    place = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    features, thresholds, values = [], [], []
    total = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feature, threshold, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        parts, bounds = {0: np.arange(len(y))}, {0: (-np.inf, np.inf)}
        for node in range(2 * inner + 1):
            rows, (low, high) = parts[node], bounds[node]
            if node >= inner:
                step = np.clip(grad[rows].sum() / (hess[rows].sum() + ridge), low, high)
                value[node - inner] = rate * step
                total[rows] += rate * step
                continue
            cut = _best_cut(place[rows], grad[rows], hess[rows], edges, monotone, low, high, ridge, least)
            left, right = 2 * node + 1, 2 * node + 2
            if cut is None:
                parts[left], parts[right] = rows, rows[:0]
                bounds[left] = bounds[right] = (low, high)
                continue
            f, at, middle = cut
            feature[node], threshold[node] = f, edges[f][at]
            goes_right = place[rows, f] > at
            parts[left], parts[right] = rows[~goes_right], rows[goes_right]
            bounds[left] = bounds[right] = (low, high)
            if monotone[f] > 0:
                bounds[left], bounds[right] = (low, middle), (middle, high)
            elif monotone[f] < 0:
                bounds[left], bounds[right] = (middle, high), (low, middle)
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(start, np.array(features), np.array(thresholds), np.array(values))


def _best_cut(place, grad, hess, edges, monotone, low, high, ridge, least):
    """Feature, cut and the value between the sides with the largest gain, if any gains."""
    best, gain_best = None, 1e-6
    g_all, h_all = grad.sum(), hess.sum()
    whole = np.clip(g_all / (h_all + ridge), low, high)
    base = g_all * whole - 0.5 * (h_all + ridge) * whole * whole
    for f, e in enumerate(edges):
        if not len(e):
            continue
        n = len(e) + 1
        count = np.bincount(place[:, f], minlength=n).cumsum()[:-1]
        g = np.bincount(place[:, f], grad, n).cumsum()[:-1]
        h = np.bincount(place[:, f], hess, n).cumsum()[:-1]
        left = np.clip(g / (h + ridge), low, high)
        right = np.clip((g_all - g) / (h_all - h + ridge), low, high)
        gain = (g * left - 0.5 * (h + ridge) * left ** 2 + (g_all - g) * right
                - 0.5 * (h_all - h + ridge) * right ** 2 - base)
        good = (count >= least) & (len(place) - count >= least) & (monotone[f] * (right - left) >= 0)
        gain = np.where(good, gain, -np.inf)
        at = int(gain.argmax())
        if gain[at] > gain_best:
            best, gain_best = (f, at, (left[at] + right[at]) / 2), gain[at]
    return best
