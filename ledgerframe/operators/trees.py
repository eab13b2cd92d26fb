"""Regression trees with exact splits for the months of one series.

A series has as many rows as it has months, so a whole ensemble is grown inside one task;
Spark spreads the series, and a forest's trees, over the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

FOREST_DEPTH = 5
BOOSTING_DEPTH = 3
STEP = 0.05
SEED = 42
# values closer than this are not split apart
LEAST_GAP = 1e-7


class Tree(NamedTuple):
    """Nodes in the order they were made; a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            inner = self.feature[at] >= 0
            if not inner.any():
                return self.value[at]
            rows, node = np.nonzero(inner)[0], at[inner]
            low = x[rows, self.feature[node]] <= self.threshold[node]
            at[rows] = np.where(low, self.left[node], self.right[node])


def sorted_rows(x: np.ndarray) -> np.ndarray:
    """Row numbers in the order of each feature, one line per feature; for ``grow``."""
    return np.argsort(x, axis=0, kind="stable").T


def _mixed(h: np.ndarray, seed: int) -> np.ndarray:
    """64 bits drawn by hash from each number and the seed."""
    h = (h.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= np.uint64(seed * 0xD1B54A32D192ED03 + SEED & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def feature_order(tree: int, node: int, features: int) -> np.ndarray:
    """The order in which a node prefers features. Months that rise with time are parted
    alike by several features, and trees should not all take the same one."""
    return np.argsort(_mixed(np.arange(features) + features * node, tree + (1 << 32)))


def _split(x: np.ndarray, y: np.ndarray, w: np.ndarray, order: np.ndarray, liked: np.ndarray) -> tuple[int, float] | None:
    """Feature and threshold with the largest fall of squared error, from prefix sums along
    each feature's order. Equal falls: first of ``liked``, lowest threshold."""
    values = x[order, np.arange(len(order))[:, None]]
    sums, weights = np.cumsum((w * y)[order], axis=1), np.cumsum(w[order], axis=1)
    total, weight = sums[:, -1:], weights[:, -1:]
    left, below = sums[:, :-1], weights[:, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        fall = (left * weight - total * below) ** 2 / (below * (weight - below))
    fall[values[:, 1:] - values[:, :-1] <= LEAST_GAP] = -1.0
    # what rounding makes of equal falls shall not decide
    best = np.max(fall, initial=-1.0)
    if not best > 0:
        return None
    f, k = np.argwhere((fall >= best * (1 - 1e-12))[liked])[0]
    f = liked[f]
    return int(f), (values[f, k] + values[f, k + 1]) / 2


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, order: np.ndarray, number: int = 0) -> Tree:
    """A tree of at most ``depth`` splits above a leaf; rows of weight 0 take no part.

    ``number`` is the tree's in its ensemble.
    """
    nodes: list[list[float]] = []
    todo = [(_taking(order, w > 0), depth, -1, 0)]
    while todo:
        own, left_depth, parent, side = todo.pop()
        rows = own[0]
        here = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(np.average(y[rows], weights=w[rows])) if len(rows) else 0.0])
        if parent >= 0:
            nodes[parent][2 + side] = here
        found = _split(x, y, w, own, feature_order(number, here, len(order))) if left_depth and len(rows) > 1 else None
        if found:
            nodes[here][0], nodes[here][1] = found
            low = x[:, found[0]] <= found[1]
            todo += [(_taking(own, ~low), left_depth - 1, here, 1), (_taking(own, low), left_depth - 1, here, 0)]
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    return Tree(feature.astype(np.int64), threshold, left.astype(np.int64), right.astype(np.int64), value)


def _taking(order: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted rows in the order of each feature."""
    return order[wanted[order]].reshape(len(order), -1)


# ---------------------------------------------------------------- ensembles

def drawn_counts(tree: int, rows: int) -> np.ndarray:
    """How often the tree draws each row: Poisson with mean 1, by hash of (tree, row).

    The draw depends on nothing else, so a forest is the same however its trees are dealt.
    """
    uniform = (_mixed(np.arange(rows), tree) >> np.uint64(11)) / float(1 << 53)
    chances = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 15)]))
    return np.searchsorted(chances, uniform, "right").astype(float)


class Ensemble(NamedTuple):
    base: float
    step: float
    trees: Sequence[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += self.step * tree.predict(x)
        return out


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int, first: int = 0, of: int | None = None) -> Ensemble:
    """Trees ``first`` to ``first + trees`` of a forest of ``of``; they add to its mean."""
    order = sorted_rows(x)
    grown = [grow(x, y, drawn_counts(k, len(y)), FOREST_DEPTH, order, k) for k in range(first, first + trees)]
    return Ensemble(0.0, 1.0 / (of or trees), grown)


def fit_boosting(x: np.ndarray, y: np.ndarray, rounds: int) -> Ensemble:
    """Each round fits a tree to what is left and adds a step of it."""
    order, even = sorted_rows(x), np.ones(len(y))
    base = float(y.mean())
    left, grown = y - base, []
    for k in range(rounds):
        tree = grow(x, left, even, BOOSTING_DEPTH, order, k)
        left = left - STEP * tree.predict(x)
        grown.append(tree)
    return Ensemble(base, STEP, grown)
