"""Second-order boosted trees with L1, L2 and least-gain terms.

Values are put into bins of about equal counts, bounded by approximate
percentiles. A tree grows level by level. One pass over the rows per level sums
gradients and hessians by (node, feature, bin): each task adds up its own rows
in numpy, the sums of tasks meet in one grouping, and the driver sees a histogram
of at most ``2**level * features * (BINS + 1)`` cells, however many rows there
are. It picks the splits; the rows stay where they are and find their node from
the tree. Scores so far are written anew every ``REFRESH`` trees, so a pass
evaluates few trees and a lost executor costs its tasks only.

Gradients and hessians of rows that share all bins differ by their labels alone,
and either sum follows from the rows' number and the sum of their labels. So where
that at least halves the rows, one pass for each ``REFRESH`` trees counts the rows
and adds the labels that each of these trees draws from each cell, and the levels
pass over cells.

With G and H the sums of a node, T(G) = sign(G) * max(|G| - alpha, 0):
a leaf says ``-eta * T(G) / (H + lam)``; a split gains half of
``T(GL)^2 / (HL + lam) + T(GR)^2 / (HR + lam) - T(G)^2 / (H + lam)`` and stands
if that exceeds ``gamma`` and both sides weigh ``min_child_weight`` or more.

A missing value lies below all others. Rows without a label train nothing. Equal
gains go to the first feature, then the lowest bin. A row's part in a tree's
sample is a hash of its key and the tree, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.scratch import materialize

BINS = 32
REFRESH = 10
# Cells take the place of rows if they hold so many on average.
CELL_ROWS = 2
# Settings of the standing regressor.
STANDING = {"rounds": 400, "depth": 5, "eta": 0.01, "alpha": 0.05, "gamma": 0.5, "subsample": 0.7}
OBJECTIVES = ("squared", "logistic")


@dataclass
class Split:
    """A complete binary tree: node i has the children 2i + 1 and 2i + 2. A row
    goes left if its bin is at most ``cut``."""

    feature: np.ndarray  # -1 where the node is a leaf
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Split:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(int(np.log2(len(self.feature) + 1))):
            feature = self.feature[node]
            right = bins[rows, np.maximum(feature, 0)] > self.cut[node]
            node = np.where(feature < 0, node, 2 * node + 1 + right)
        return node


@dataclass
class Boosted:
    """``bounds`` has the upper bounds of each feature's bins but the last."""

    bounds: list[np.ndarray]
    base: float
    objective: str
    trees: list[Split] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bins from 1; 0 is a missing value."""
        out = np.zeros(x.shape, np.uint8)
        for j, cuts in enumerate(self.bounds):
            known = ~np.isnan(x[:, j])
            out[known, j] = np.searchsorted(cuts, x[known, j], "left") + 1
        return out

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.base + added(self.trees, bins)

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin = self.margin(self.binned(x))
        return 1 / (1 + np.exp(-margin)) if self.objective == "logistic" else margin

    def n_leaves(self) -> int:
        return sum(int((tree.value != 0).sum()) for tree in self.trees)


def added(trees: Sequence[Split], bins: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bins))
    for tree in trees:
        out += tree.value[tree.leaves(bins)]
    return out


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Feature lists as a matrix, missing values as NaN."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out = np.full((len(sizes), width), np.nan)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = cells[inside]
    return out


def drawn(hashes: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Rows of a tree's sample."""
    x = hashes.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53) < share


def percentile_bounds(data: DataFrame, features: str, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Bounds of the bins of each feature, in one pass over the rows."""
    shares = [k / bins for k in range(1, bins)]
    value = lambda j: F.get(F.col(features), F.lit(j)).cast("double")
    found = data.agg(*[F.percentile_approx(F.when(~F.isnan(value(j)), value(j)), shares, 10_000).alias(f"b{j}") for j in range(width)]).first()
    return [np.unique(np.array(found[j] or [], float)) for j in range(width)]


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def choose_splits(
    tree: Split, nodes: list[int], g: np.ndarray, h: np.ndarray, *, eta: float, alpha: float, lam: float, gamma: float, least: float, last: bool
) -> list[int]:
    """Sets leaf values of ``nodes`` and splits those that gain enough; returns
    the nodes of the next level. ``g`` and ``h`` are (node, feature, bin)."""
    below = []
    for i, node in enumerate(nodes):
        total_g, total_h = g[i, 0].sum(), h[i, 0].sum()
        tree.value[node] = -eta * _shrunk(total_g, alpha) / (total_h + lam) if total_h + lam > 0 else 0.0
        left_g, left_h = g[i].cumsum(axis=1)[:, :-1], h[i].cumsum(axis=1)[:, :-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        power = lambda a, b: _shrunk(a, alpha) ** 2 / np.maximum(b + lam, 1e-12)
        gain = (power(left_g, left_h) + power(right_g, right_h) - power(total_g, total_h)) / 2
        gain[(left_h < least) | (right_h < least) | (left_h <= 0) | (right_h <= 0)] = -np.inf
        # A gain that differs in rounding only must not decide.
        gain = np.round(gain, 9)
        feature, cut = np.unravel_index(int(gain.argmax()), gain.shape)
        if not gain[feature, cut] > gamma:
            continue
        tree.feature[node], tree.cut[node], tree.value[node] = feature, cut, 0.0
        sides = ((2 * node + 1, left_g, left_h), (2 * node + 2, right_g, right_h))
        for child, side_g, side_h in sides:
            tree.value[child] = -eta * _shrunk(side_g[feature, cut], alpha) / (side_h[feature, cut] + lam)
            if not last:
                below.append(child)
    return below


def fit(
    data: DataFrame,
    key: str,
    label: str = "label",
    features: str = "features",
    *,
    objective: str = "squared",
    rounds: int = STANDING["rounds"],
    depth: int = STANDING["depth"],
    eta: float = STANDING["eta"],
    alpha: float = STANDING["alpha"],
    gamma: float = STANDING["gamma"],
    subsample: float = STANDING["subsample"],
    lam: float = 1.0,
    min_child_weight: float = 1.0,
) -> Boosted:
    """A model of ``label`` from ``features`` (array<double>)."""
    if objective not in OBJECTIVES:
        raise ValueError(f"objective must be one of {OBJECTIVES}, not {objective!r}")
    rows = data.select(F.xxhash64(key).alias("draw"), F.col(label).cast("double").alias("label"), F.col(features).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("label").isNotNull() & ~F.isnan("label"))
    width, mean = rows.agg(F.max(F.size("x")), F.avg("label")).first()
    if mean is None:
        return Boosted([], 0.0, objective)
    share = min(max(mean, 1e-6), 1 - 1e-6)
    model = Boosted(percentile_bounds(rows, "x", width), float(np.log(share / (1 - share))) if objective == "logistic" else float(mean), objective)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned(_matrix(batch.column(2), width))
            cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(max(width, 1)), len(bins), [None, pa.py_buffer(bins.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cells.cast(pa.binary())], ["draw", "label", "bins"])

    kept = materialize(rows.mapInArrow(binned, "draw bigint, label double, bins binary").withColumn("margin", F.lit(model.base)), "binned-rows")
    n_rows, n_cells = kept.agg(F.count(F.lit(1)), F.approx_count_distinct("bins")).first()
    shared, written = CELL_ROWS * n_cells <= n_rows, 0
    used = _cells(kept, range(min(REFRESH, rounds)), subsample, model, width) if shared else kept
    for number in range(rounds):
        if number - written == REFRESH:
            if shared:
                used = _cells(kept, range(number, min(number + REFRESH, rounds)), subsample, model, width)
            else:
                used = kept = materialize(_with_margin(kept, model.trees[written:], width), "binned-rows")
            written = number
        tree, nodes = Split.empty(depth), [0]
        drawn = _of_tree(used, number, written, subsample, shared)
        for level in range(depth):
            g, h = _histogram(drawn, model.trees[written:], tree, nodes, width, objective)
            nodes = choose_splits(
                tree, nodes, g, h, eta=eta, alpha=alpha, lam=lam, gamma=gamma, least=min_child_weight, last=level == depth - 1
            )
            if not nodes:
                break
        model.trees.append(tree)
    return model


def _bins(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _with_margin(kept: DataFrame, trees: list[Split], width: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = batch.column(3).to_numpy() + added(trees, _bins(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], batch.schema.names)

    return kept.mapInArrow(work, kept.schema)


def _flagged(kept: DataFrame, numbers: range, subsample: float) -> DataFrame:
    """Rows with a bit for each tree that draws them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = np.zeros(batch.num_rows, np.int64)
            for k, number in enumerate(numbers):
                flags |= drawn(batch.column(0).to_numpy(), number, subsample).astype(np.int64) << k
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(flags)], ["label", "bins", "flags"])

    return kept.mapInArrow(work, "label double, bins binary, flags bigint")


def _cells(kept: DataFrame, numbers: range, subsample: float, model: Boosted, width: int) -> DataFrame:
    """(bins, margin, n0, s0, ...): rows and sum of labels that each of the
    trees ``numbers`` draws from each cell. Without row samples all draw alike."""
    if subsample < 1:
        flagged = _flagged(kept, numbers, subsample)
        taken = [F.col("flags").bitwiseAND(1 << k) != 0 for k in range(len(numbers))]
    else:
        flagged, taken = kept, [F.lit(True)]
    sums = []
    for k, mine in enumerate(taken):
        sums += [F.count_if(mine).cast("double").alias(f"n{k}"), F.sum(F.when(mine, F.col("label")).otherwise(0.0)).alias(f"s{k}")]
    trees, base = list(model.trees), model.base
    cells = flagged.groupBy("bins").agg(*sums)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = base + added(trees, _bins(batch.column(0), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], [*batch.schema.names, "margin"])

    return materialize(cells.mapInArrow(work, T.StructType([*cells.schema, T.StructField("margin", T.DoubleType())])), "boosting-cells")


def _of_tree(used: DataFrame, number: int, written: int, subsample: float, shared: bool) -> DataFrame:
    """(bins, n, s, margin): what one tree draws, by cell or by row."""
    if shared:
        k = number - written if subsample < 1 else 0
        return used.select("bins", F.col(f"n{k}").alias("n"), F.col(f"s{k}").alias("s"), "margin").filter("n > 0")
    if subsample >= 1:
        return used.select("bins", F.lit(1.0).alias("n"), F.col("label").alias("s"), "margin")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = batch.filter(pa.array(drawn(batch.column(0).to_numpy(), number, subsample)))
            ones = pa.array(np.ones(mine.num_rows))
            yield pa.RecordBatch.from_arrays([mine.column(2), ones, mine.column(1), mine.column(3)], ["bins", "n", "s", "margin"])

    return used.mapInArrow(work, "bins binary, n double, s double, margin double")


def _histogram(drawn: DataFrame, recent: list[Split], tree: Split, nodes: list[int], width: int, objective: str) -> tuple[np.ndarray, np.ndarray]:
    """Sums of gradients and hessians by node, feature and bin."""
    shape = (len(nodes), width, BINS + 1)
    size = int(np.prod(shape))
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size))
        for batch in batches:
            bins = _bins(batch.column(0), width)
            at = place[tree.leaves(bins)]
            inside = np.flatnonzero(at >= 0)
            bins, at, n, y = bins[inside], at[inside], batch.column(1).to_numpy()[inside], batch.column(2).to_numpy()[inside]
            margin = batch.column(3).to_numpy()[inside] + added(recent, bins)
            if objective == "logistic":
                p = 1 / (1 + np.exp(-margin))
                slope, weight = n * p - y, n * p * (1 - p)
            else:
                slope, weight = n * margin - y, n
            for j in range(width):
                cell = (at * width + j) * (BINS + 1) + bins[:, j]
                sums[0] += np.bincount(cell, slope, size)
                sums[1] += np.bincount(cell, weight, size)
        some = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[0, some]), pa.array(sums[1, some])], ["cell", "g", "h"])

    met = drawn.mapInArrow(work, "cell bigint, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    g, h = np.zeros(size), np.zeros(size)
    for cell, slope, weight in met.collect():  # one row per cell of the histogram
        g[cell], h[cell] = slope, weight
    return g.reshape(shape), h.reshape(shape)


def score(model: Boosted, data: DataFrame, *keep: str, features: str = "features") -> DataFrame:
    """The kept columns and ``prediction``: a value, or the probability of 1."""
    width = len(model.bounds)
    schema = T.StructType([*[data.schema[name] for name in keep], T.StructField("prediction", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = model.predict(_matrix(batch.column(len(keep)), width))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made)], schema.names)

    return data.select(*keep, F.col(features).cast("array<double>")).mapInArrow(work, schema)
