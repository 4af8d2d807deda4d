"""Decision trees over binned features, for boosting and for forests."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Tree:
    """A complete binary tree: node i has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # -1 where the node is a leaf
    limit: np.ndarray  # values up to the limit go left
    value: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            feature = self.feature[node]
            right = x[rows, np.maximum(feature, 0)] > self.limit[node]
            node = np.where(feature < 0, node, 2 * node + 1 + right)
        return self.value[node]


def bin_limits(x: np.ndarray) -> list[np.ndarray]:
    """Upper limits of the bins of each feature, at most ``BINS - 1``."""
    places = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], places, method="lower")) for j in range(x.shape[1])]


def binned(x: np.ndarray, limits: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(cut, x[:, j], "left") for j, cut in enumerate(limits)], axis=1)


def grow(
    bins: np.ndarray,
    limits: list[np.ndarray],
    slope: np.ndarray,
    weight: np.ndarray,
    depth: int,
    smoothing: float = 1.0,
    least: float = 1.0,
    tried: int | None = None,
    rng: np.random.Generator | None = None,
) -> Tree:
    """A tree whose leaves hold sum(slope) / (sum(weight) + smoothing).

    Splits maximise the sum of squared slopes over weights. ``least`` is the
    smallest weight of a child; ``tried`` features are drawn for each node.
    """
    n_nodes = 2 ** (depth + 1) - 1
    tree = Tree(np.full(n_nodes, -1), np.zeros(n_nodes), np.zeros(n_nodes), depth)
    members = {0: np.arange(len(bins))}
    n_features = bins.shape[1]
    for node in range(n_nodes):
        rows = members.pop(node, None)
        if rows is None:
            continue
        g, h = slope[rows], weight[rows]
        total_g, total_h = g.sum(), h.sum()
        tree.value[node] = total_g / (total_h + smoothing)
        if 2 * node + 2 >= n_nodes or total_h < 2 * least:
            continue
        features = np.arange(n_features) if tried is None else rng.choice(n_features, min(tried, n_features), replace=False)
        cell = bins[rows][:, features] + np.arange(len(features)) * BINS
        shape = (len(features), BINS)
        left_g = np.bincount(cell.ravel(), np.repeat(g, len(features)), len(features) * BINS).reshape(shape).cumsum(axis=1)
        left_h = np.bincount(cell.ravel(), np.repeat(h, len(features)), len(features) * BINS).reshape(shape).cumsum(axis=1)
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g**2 / (left_h + smoothing) + right_g**2 / (right_h + smoothing)
        gain -= total_g**2 / (total_h + smoothing)
        gain[(left_h < least) | (right_h < least)] = -1
        best, cut = np.unravel_index(int(gain.argmax()), shape)
        if gain[best, cut] <= 1e-9:
            continue
        feature = int(features[best])
        tree.feature[node], tree.limit[node] = feature, limits[feature][cut]
        left = bins[rows, feature] <= cut
        members[2 * node + 1], members[2 * node + 2] = rows[left], rows[~left]
    return tree


@dataclass
class Boosted:
    """Gradient-boosted trees for a yes/no question."""

    trees: list[Tree]
    start: float
    rate: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2) -> Boosted:
        limits = bin_limits(x)
        bins = binned(x, limits)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        start = float(np.log(share / (1 - share)))
        score, trees = np.full(len(y), start), []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            tree = grow(bins, limits, y - p, p * (1 - p), depth)
            trees.append(tree)
            score += rate * tree.predict(x)
        return cls(trees, start, rate)

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self.rate * tree.predict(x)
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


@dataclass
class Forest:
    """A random forest: trees on redrawn rows, few features tried at each node."""

    trees: list[Tree]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 9, seed: int = 5) -> Forest:
        rng = np.random.default_rng(seed)
        limits = bin_limits(x)
        bins = binned(x, limits)
        tried = max(1, int(np.ceil(x.shape[1] ** 0.5)))
        trees = []
        for _ in range(n_trees):
            rows = rng.integers(0, len(x), len(x))
            ones = np.ones(len(rows))
            # Smoothing 0: a leaf holds the share of positives; the split gain is that of the Gini index.
            trees.append(grow(bins[rows], limits, y[rows].astype(float), ones, depth, 1e-9, 2, tried, rng))
        return cls(trees)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.mean([tree.predict(x) for tree in self.trees], axis=0), 0, 1) if len(x) else np.zeros(0)
