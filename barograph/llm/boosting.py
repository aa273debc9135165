"""Gradient-boosted trees for two classes, with monotonic constraints, as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TreeParams:
    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 64
    #: Least sum of second derivatives in a leaf, and the L2 penalty of leaf values.
    least_weight: float = 2.0
    penalty: float = 1.0


@dataclass(frozen=True)
class FlatTrees:
    """All trees' nodes in one set of arrays; a leaf is its own child on both sides."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The log-odds of each row: every tree descends a level at a time, all rows at once."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                low = rows[every, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at]
        return total


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def _best_split(grad, hess, constraint, low, high, params):
    """The best (gain, feature, bin, left value, right value) by histograms, or None.

    ``constraint`` is -1, 0 or 1 per feature: a split whose sides' values go the
    other way is not taken. Values are held within the node's bounds.
    """
    left_g, left_h = np.cumsum(grad, axis=1)[:, :-1], np.cumsum(hess, axis=1)[:, :-1]
    all_g, all_h = grad.sum(axis=1, keepdims=True), hess.sum(axis=1, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h

    def value(g, h):
        return np.clip(-g / (h + params.penalty), low, high)

    def gain(g, h, w):
        return -(2 * g * w + (h + params.penalty) * w * w)

    left, right, whole = value(left_g, left_h), value(right_g, right_h), value(all_g, all_h)
    gains = gain(left_g, left_h, left) + gain(right_g, right_h, right) - gain(all_g, all_h, whole)
    allowed = (left_h >= params.least_weight) & (right_h >= params.least_weight)
    allowed &= constraint[:, None] * (right - left) >= 0
    gains = np.where(allowed, gains, -np.inf)
    best = np.unravel_index(np.argmax(gains), gains.shape)
    if not gains[best] > 1e-9:
        return None
    return best[0], best[1], left[best], right[best]


def fit(
    rows: np.ndarray, label: np.ndarray, constraint: np.ndarray, params: TreeParams = TreeParams()
) -> FlatTrees:
    """Fit trees to labels 0 and 1. ``constraint``: 1 if more of a feature may only help."""
    n, width = rows.shape
    edges = [_edges(rows[:, k], params.bins) for k in range(width)]
    binned = np.stack([np.searchsorted(edges[k], rows[:, k]) for k in range(width)], axis=1)
    slots = params.bins + 1
    flat = binned + np.arange(width) * slots
    rate = np.clip(label.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(rate / (1 - rate)))
    odds = np.full(n, base)
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []

    def grow(own, depth, low, high, value, grad, hess):
        at = len(nodes)
        nodes.append([0, np.inf, at, at, value * params.rate])
        odds_change[own] = value * params.rate
        if depth == params.depth or len(own) < 2:
            return at
        cells = flat[own].ravel()
        shape = (width, slots)
        g = np.bincount(cells, np.repeat(grad[own], width), width * slots).reshape(shape)
        h = np.bincount(cells, np.repeat(hess[own], width), width * slots).reshape(shape)
        split = _best_split(g, h, constraint, low, high, params)
        if split is None or split[1] >= len(edges[split[0]]):
            return at
        k, cut, left, right = split
        is_low = binned[own, k] <= cut
        middle = (left + right) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high))}
        bounds[-1] = bounds[1][::-1]
        (low_l, high_l), (low_r, high_r) = bounds[int(constraint[k])]
        nodes[at][:2] = [k, edges[k][cut]]
        nodes[at][2] = grow(own[is_low], depth + 1, low_l, high_l, left, grad, hess)
        nodes[at][3] = grow(own[~is_low], depth + 1, low_r, high_r, right, grad, hess)
        return at

    for _ in range(params.trees):
        chance = 1 / (1 + np.exp(-odds))
        grad, hess = chance - label, chance * (1 - chance)
        odds_change = np.zeros(n)
        start = -grad.sum() / (hess.sum() + params.penalty)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf, start, grad, hess))
        odds += odds_change
    feature, threshold, left, right, value = zip(*nodes, strict=True)
    return FlatTrees(
        base,
        params.depth,
        np.array(roots),
        np.array(feature),
        np.array(threshold, dtype=float),
        np.array(left),
        np.array(right),
        np.array(value, dtype=float),
    )
