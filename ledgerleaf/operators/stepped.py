"""Many small regression trees, grown over cells.

Four hundred trees of five levels are two thousand passes over the training rows.
Spark's learner starts a job of two stages for each of them and finds its place in
every point anew, and its model walks through objects to score a row. Here the rows
that share all bins (and the piece that row samples draw them by) are grouped by a
shuffle, and tasks keep the columns of their cells and the residuals so far. A job
of one stage adds up in numpy what two levels need: sums by node, pair of features
and pair of bins, from which a level's histograms and, once it is split, those of
the next one follow. The driver sees these sums, however many rows there are, and
picks the splits; cells and residuals stay with the tasks. Rows are scored by the
bins between the model's thresholds, from a list of all combinations if that is
short.

The trees are those of Spark's learner for squared errors: the first is fitted to
the labels, each further one to twice the residuals and counts by the step; splits
lessen the variance, thresholds lie midway between the values of neighbouring bins.
"""

from __future__ import annotations

import json
import math
from functools import partial

from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import cell_trees
from ledgerleaf.scratch import ensure_checkpoint_dir, materialize

# Pieces that the rows of a cell are dealt over, each drawn by itself.
PIECES = 8
# A task holds no more cells; a table with more is left to Spark's learner.
TASK_CELLS = 500_000
# Fewer cells are not worth a task of their own.
LEAST_CELLS = 10_000
# What the learner here knows of Spark's settings; others are left to Spark's.
KNOWN = {"featuresCol", "labelCol", "predictionCol", "maxIter", "stepSize", "maxDepth", "maxBins", "subsamplingRate", "minInfoGain", "seed"}


def can_fit(estimator) -> bool:
    """Whether all settings are known here."""
    given = {param.name for param in estimator.params if estimator.isSet(param)}
    return given <= KNOWN and estimator.getMinInfoGain() == 0 and 0 < estimator.getMaxDepth() <= 10 and estimator.getMaxBins() <= 256


def fit(rows: DataFrame, cuts: list[list[float]], estimator) -> SteppedModel | None:
    """A model of the rows (label, ``x0``, ``x1``, ..., piece), whose features are
    finite and whose labels are known; ``cuts`` are the lowest values of the bins.
    Nothing if the tasks could not hold the cells."""
    spark, width = rows.sparkSession, len(cuts)
    share = estimator.getSubsamplingRate()
    names, places = [f"x{j}" for j in range(width)], [f"b{j}" for j in range(width)]
    edges = [[-math.inf, *(mine or [0.0]), math.inf] for mine in cuts]
    flat = Bucketizer(splitsArray=edges, inputCols=names, outputCols=places).transform(rows)
    pieces = PIECES if share < 1 else 1
    mine = [F.col("piece") == p if share < 1 else F.lit(True) for p in range(pieces)]
    grouped = flat.groupBy(*[F.col(name).cast("int").alias(name) for name in places]).agg(
        *[F.count_if(own).cast("double").alias(f"w{p}") for p, own in enumerate(mine)],
        *[F.sum(F.when(own, F.col("label")).otherwise(0.0)).alias(f"s{p}") for p, own in enumerate(mine)],
        *[F.max(name).alias(f"hi{j}") for j, name in enumerate(names)],
    )
    cells = materialize(grouped.withColumn("draw", F.xxhash64(F.lit(estimator.getSeed()), *places)), "weighed-rows")
    n_cells, slots = cells.count(), spark.sparkContext.defaultParallelism
    if n_cells > slots * TASK_CELLS:
        return None

    # Highest value of each bin: bins * features rows.
    sides = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b{j}").alias("b"), F.col(f"hi{j}").alias("hi")) for j in range(width)]))
    highest = {(row.j, row.b): row.hi for row in cells.select(sides.alias("s")).groupBy("s.j", "s.b").agg(F.max("s.hi").alias("hi")).collect()}
    settings = {"share": share, "rounds": estimator.getMaxIter(), "depth": estimator.getMaxDepth(), "step": estimator.getStepSize()}
    tasks = max(1, min(slots, n_cells // LEAST_CELLS))
    columns = ["draw", *[f"{of}{p}" for of in "ws" for p in range(pieces)], *places]
    dealt = cells.select(*columns).repartition(tasks, "draw").sortWithinPartitions("draw", *places)
    packed = dealt.mapInArrow(partial(cell_trees.packed, pieces=pieces, width=width), "draw binary, sums binary, bins binary")
    ensure_checkpoint_dir(spark)
    grown = cell_trees.grow(packed, [len(edge) - 1 for edge in edges], pieces, **settings)
    trees = []
    for tree in grown:
        # A bin that no row is in has no highest value; the cut moves to one that has.
        at = [math.nan if j < 0 else _threshold(j, b, cuts[j], highest) for j, b in zip(tree.feature.tolist(), tree.cut.tolist())]
        trees.append((tree.feature.tolist(), at, tree.value.tolist()))
    return SteppedModel(json.dumps(trees), width, estimator.getFeaturesCol(), estimator.getPredictionCol())


def _threshold(j: int, b: int, cuts: list[float], highest: dict) -> float:
    """Midway between the highest value of the bins up to ``b`` and the lowest above."""
    below = max(hi for (i, k), hi in highest.items() if i == j and k <= b)
    middle = below / 2 + cuts[b] / 2
    return middle if below <= middle < cuts[b] else below


class SteppedModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted trees, as JSON of [features, thresholds, values] by node; node i
    has the children 2i + 1 and 2i + 2, and values up to the threshold go left."""

    trees = Param(Params._dummy(), "trees", "the trees by node", typeConverter=TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of features", typeConverter=TypeConverters.toInt)

    @keyword_only
    def _given(self, *, trees=None, width=None, featuresCol=None, predictionCol=None):
        return self._set(**self._input_kwargs)

    def __init__(self, trees: str | None = None, width: int | None = None, featuresCol: str = "features", predictionCol: str = "prediction"):
        super().__init__()
        self._given(trees=trees, width=width, featuresCol=featuresCol, predictionCol=predictionCol)

    def getNumTrees(self) -> int:
        return len(json.loads(self.getOrDefault(self.trees)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        width, text = self.getOrDefault(self.width), self.getOrDefault(self.trees)
        score = cell_trees.Scorer(json.loads(text), width)

        predicted = F.arrow_udf(lambda *columns: score(*columns), "double")
        values = vector_to_array(self.getFeaturesCol())
        checked = F.when(F.size(values) == width, values).otherwise(F.raise_error(F.lit(f"features must be {width} numbers")))
        return dataset.withColumn(self.getPredictionCol(), predicted(*[F.get(checked, F.lit(j)) for j in range(width)]))
