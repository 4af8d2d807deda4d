"""What tasks and driver do to grow and apply the trees of :mod:`stepped`.

Tasks import this file, so it needs none of the learners."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ledgerleaf.operators.boosting import REFRESH, Split, choose_splits, drawn

# Sums of pairs of bins that a task sends for one node.
MOST_PAIRED = 1 << 14
# Scores of all combinations of bins are listed if there are no more.
MOST_LISTED = 1 << 18


def packed(batches: Iterator[pa.RecordBatch], pieces: int, width: int) -> Iterator[pa.RecordBatch]:
    """The cells of a task as one row: draws, rows and labels by piece, bins."""
    parts = [[column.to_numpy() for column in batch.columns] for batch in batches]
    kinds = [np.int64, *[np.float64] * 2 * pieces, *[np.uint8] * width]
    columns = [np.concatenate(c).astype(kind) for c, kind in zip(zip(*parts), kinds)] if parts else [np.zeros(0, kind) for kind in kinds]
    blocks = [columns[0], np.stack(columns[1 : 2 * pieces + 1]), np.stack(columns[2 * pieces + 1 :])]
    yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary()) for block in blocks], ["draw", "sums", "bins"])


def _held(row: tuple, trees: list[Split], pieces: int, width: int) -> tuple:
    """A task's cells: draws, sums by piece, bins and the scores so far."""
    draw, sums, bins = (np.frombuffer(block, kind) for block, kind in zip(row, (np.int64, np.float64, np.uint8)))
    bins = bins.reshape(width, len(draw))
    return draw, sums.reshape(2, pieces, len(draw)), bins, _scores(trees, bins)


def _scores(trees: list[Split], bins: np.ndarray) -> np.ndarray:
    return sum((tree.value[_nodes(tree, bins)] for tree in trees), np.zeros(bins.shape[1]))


def _nodes(tree: Split, bins: np.ndarray) -> np.ndarray:
    """The node each cell ends in, of the levels that are grown."""
    n = bins.shape[1]
    node, flat, rows = np.zeros(n, np.int64), bins.reshape(-1), np.arange(n)
    while (tree.feature[node] >= 0).any():
        feature = tree.feature[node]
        right = flat[np.maximum(feature, 0) * n + rows] > tree.cut[node]
        node = np.where(feature < 0, node, 2 * node + 1 + right)
    return node


def _sums(held: tuple, recent: list[Split], tree: Split, nodes: list[int], number: int, share: float, most: int, two: bool) -> np.ndarray:
    """Sums of slopes and weights of the cells by node, feature and bin or, for two
    levels at once, by node, pair of features and pair of bins."""
    draw, (w, s), bins, score = held
    score = score + _scores(recent, bins)
    if share < 1:
        taken = np.stack([drawn(draw + p, number, share) for p in range(len(w))])
        w, s = w * taken, s * taken
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    at, weight = place[_nodes(tree, bins)], w.sum(axis=0)
    mine = np.flatnonzero((at >= 0) & (weight > 0))
    slope = (weight * score - s.sum(axis=0))[mine]
    at, weight, bins = at[mine], weight[mine], bins[:, mine].astype(np.int64)
    out = []
    for cell, size in _places(at, bins, most, two):
        out.append([np.bincount(cell, value, len(nodes) * size).reshape(-1, size) for value in (slope, weight)])
    return np.array(out)


def _places(at: np.ndarray, bins: np.ndarray, most: int, two: bool) -> Iterator[tuple[np.ndarray, int]]:
    if not two:
        yield from ((at * most + one, most) for one in bins)
    for i, j in combinations(range(len(bins)), 2) if two else ():
        yield (at * most + bins[i]) * most + bins[j], most * most


def grow(cells: DataFrame, bins: list[int], pieces: int, share: float, rounds: int, depth: int, step: float) -> list[Split]:
    """All trees. A job of one stage adds up what one level needs, or two levels."""
    width, most, trees = len(bins), max(bins), []
    # Sums of pairs of bins serve two levels, if they are few.
    pairs = list(combinations(range(width), 2))
    paired = 2 <= width and len(pairs) * most * most <= MOST_PAIRED
    # Kept behind a checkpoint: the plan that made the cells would go along with each job.
    kept = cells.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    kept.checkpoint()
    kept.count()
    held, before, known = None, None, 0
    for number in range(rounds):
        if number % REFRESH == 0:
            # Made from the cells and all trees, so no lineage grows.
            before, known = held, number
            held = kept.map(partial(_held, trees=list(trees), pieces=pieces, width=width)).persist(StorageLevel.MEMORY_AND_DISK)
        tree, nodes, level = Split.empty(depth), [0], 0
        # The first tree stands for the labels; later ones follow the slope of squared errors.
        chosen = partial(choose_splits, tree, eta=1.0 if number == 0 else 2 * step, alpha=0.0, lam=0.0, gamma=0.0, least=0.0)
        while nodes and level < depth:
            two = paired and level + 1 < depth
            # A histogram from each task.
            found = sum(held.map(partial(_sums, recent=trees[known:], tree=tree, nodes=nodes, number=number, share=share, most=most, two=two)).collect())
            if two:
                joint = dict(zip(pairs, found.reshape(len(pairs), 2, len(nodes), most, most)))
                single = np.stack([joint[0, 1].sum(axis=3), *[joint[0, j].sum(axis=2) for j in range(1, width)]])
            else:
                single = found
            g, h = single.transpose(1, 2, 0, 3)  # node, feature, bin
            parents, nodes, level = nodes, chosen(nodes, g, h, last=level == depth - 1), level + 1
            if two and nodes:
                g, h = _below(tree, parents, joint, single)
                nodes, level = chosen(nodes, g, h, last=level == depth - 1), level + 1
        trees.append(tree)
        if before is not None:
            before.unpersist()
            before = None
    kept.unpersist()
    if held is not None:
        held.unpersist()
    return trees


def _below(tree: Split, parents: list[int], joint: dict, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by child, feature and bin of the parents that were split."""
    width, _, _, most = single.shape
    children = []
    for p, parent in enumerate(parents):
        f, c = tree.feature[parent], tree.cut[parent] + 1
        if f < 0:
            continue
        sides = np.zeros((2, width, 2, most))
        for j in range(width):
            if j == f:
                sides[0, j, :, :c], sides[1, j, :, c:] = single[f, :, p, :c], single[f, :, p, c:]
                continue
            pair = joint[f, j][:, p] if f < j else joint[j, f][:, p].transpose(0, 2, 1)  # side, bin of f, bin of j
            sides[0, j], sides[1, j] = pair[:, :c].sum(axis=1), pair[:, c:].sum(axis=1)
        children += [*sides]
    return np.stack(children).transpose(2, 0, 1, 3)


class Scorer:
    """Trees over the bins between their thresholds."""

    def __init__(self, trees: list, width: int):
        self.trees = [(np.array(f), np.array(t, float), np.array(v, float)) for f, t, v in trees]
        self.bounds = [np.unique([t for f, at, _ in self.trees for t in at[f == j]]) for j in range(width)]
        self.shape = tuple(len(b) + 1 for b in self.bounds)
        self.splits = []
        for f, at, v in self.trees:
            cut = np.zeros(len(f), np.int64)
            for j, bound in enumerate(self.bounds):
                cut[f == j] = np.searchsorted(bound, at[f == j])
            self.splits.append(Split(f, cut, v))
        self.listed = None
        if math.prod(self.shape) <= MOST_LISTED:
            self.listed = self._summed(np.indices(self.shape).reshape(width, math.prod(self.shape)).T)

    def _summed(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bins))
        for split in self.splits:
            out += split.value[split.leaves(bins)]
        return out

    def __call__(self, *columns: pa.Array) -> pa.Array:
        values = [column.to_numpy(zero_copy_only=False) for column in columns]
        bins = [np.searchsorted(bound, x, "left") for bound, x in zip(self.bounds, values)]
        if self.listed is not None:
            return pa.array(self.listed[np.ravel_multi_index(bins, self.shape)])
        return pa.array(self._summed(np.stack(bins, axis=1)))
