"""Models on Spark's DataFrame learners. Each function returns the fitted
model; scoring keeps the caller's key beside the prediction.

Boosted trees pass over their rows hundreds of times and see no more of a value
than its bin. Rows that share all bins are therefore grouped first and weighed
(:func:`weighed`), wherever that at least halves them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.operators import stepped
from ledgerleaf.scratch import ensure_checkpoint_dir, materialize

# Settings of the standing models.
FOREST = {"numTrees": 10, "maxDepth": 4, "maxBins": 32, "impurity": "gini", "featureSubsetStrategy": "auto"}
BOOSTED = {"maxIter": 100, "stepSize": 0.0001, "validationTol": 0.000001, "maxDepth": 6}
BOOSTED_CLASSIFIER = {"maxIter": 10, "featureSubsetStrategy": "auto"}
GRADIENT_CLASSIFIER = {"stepSize": 0.1, "maxDepth": 6, "maxIter": 10}
GRADIENT_REGRESSOR = {"stepSize": 0.01, "maxDepth": 5, "maxIter": 400, "subsamplingRate": 0.7, "minInfoGain": 0.0}
LOGISTIC = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
CLUSTERS = {"k": 2, "seed": 1}
# Rows with more features than this hardly ever share all bins.
MOST_GROUPED = 16
# A learner with row samples draws among the pieces of a cell, not whole cells.
PIECES = 4
# Numbers that one task holds of a learner's rows. Learners keep more of a row than
# its features (bins, a weight for each tree), so a row counts as ROW_NUMBERS more.
TASK_NUMBERS = 8_000_000
ROW_NUMBERS = 16
# Less than this is not worth a task of its own.
LEAST_NUMBERS = 400_000


def balanced(data: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Training rows spread evenly by their unique key.

    A learner passes over its rows many times, so one shuffle pays when the rows
    lie in few or uneven files. The number of tasks follows the number (counted
    here) and width of the rows: their packed size is a poor measure of what a
    learner holds of them, and a task's share must not grow with the table.
    """
    some = data.select(F.size(vector_to_array(features))).first()
    numbers = data.count() * ((some[0] or 0) + ROW_NUMBERS) if some else 0
    spread = min(data.sparkSession.sparkContext.defaultParallelism, numbers // LEAST_NUMBERS)
    return data.repartition(max(1, spread, math.ceil(numbers / TASK_NUMBERS)), key)


def _ready(data: DataFrame, estimator) -> Model:
    # Boosting builds a long lineage; checkpoints in the shared folder cut it.
    ensure_checkpoint_dir(data.sparkSession)
    return estimator.fit(data)


def _cuts(rows: DataFrame, width: int, bins: int) -> tuple[list[list[float]], int, bool]:
    """Lowest values of each feature's bins (all values if there are at most
    ``bins``, else those that part the rows about evenly), the rows (none if a
    vector has another width), and whether all labels are known and all values
    finite."""
    value = [F.get("x", F.lit(j)) for j in range(width)]
    shares = [k / bins for k in range(1, bins)]
    found = rows.agg(
        *[F.percentile_approx(F.when(~F.isnan(v), v), shares, 1_000).alias(f"p{j}") for j, v in enumerate(value)],
        *[F.approx_count_distinct(v).alias(f"n{j}") for j, v in enumerate(value)],
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("x") != width).alias("other"),
        F.count_if(~F.coalesce(_finite("label") & F.forall("x", _finite), F.lit(False))).alias("odd"),
    ).first()
    few = [j for j in range(width) if found[f"n{j}"] <= 2 * bins]
    listed = rows.agg(*[F.collect_set(value[j]).alias(f"s{j}") for j in few]).first() if few else {}
    cuts = []
    for j in range(width):
        mine = listed[f"s{j}"] if j in few and len(listed[f"s{j}"]) <= bins else found[f"p{j}"]
        cuts.append(sorted({x for x in mine or [] if math.isfinite(x)}))
    return cuts, 0 if found["other"] else found["rows"], not found["odd"]


def _finite(value: Column | str) -> Column:
    return F.abs(value) < math.inf  # a NaN is greater than all numbers


def weighed(data: DataFrame, estimator, keep: Sequence[str] = (), mean: bool = False, pieces: int = 1) -> DataFrame | None:
    """(label, features, weight, kept columns): the rows grouped by the bins of
    their features, or nothing if that does not halve them.

    Trees learn the same from it, as all rows of a cell fall on one side of a cut
    between bins. A cell stands at the lowest and at the highest values of its
    bins, half its weight at either, so the learner puts its thresholds (midway
    between neighbouring values) in the gaps between bins; a cut inside a bin parts
    equal halves and gains less than one of the cuts around it. Classes stay apart.
    With ``mean`` labels are numbers, and a cell has the mean (and with kept columns
    the deviation) of its rows, which are all that squared errors depend on. ``pieces`` deals the rows of
    a cell over as many parts.
    """
    features, label, bins = estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getMaxBins()
    rows = data.select(F.col(label).cast("double").alias("label"), vector_to_array(features).alias("x"), *keep)
    some = rows.select(F.size("x")).first()
    width = some[0] if some else 0
    if not 0 < width <= MOST_GROUPED:
        return None
    cuts, n_rows, _ = _cuts(rows, width, bins)
    if not n_rows:
        return None
    names = [f"b{j}" for j in range(width)]
    flat = rows.select("label", *keep, *[F.get("x", F.lit(j)).alias(f"x{j}") for j in range(width)])
    edges = [[-math.inf, *(mine or [0.0]), math.inf] for mine in cuts]
    # A value that is not a number has a bin of its own.
    flat = Bucketizer(splitsArray=edges, inputCols=[f"x{j}" for j in range(width)], outputCols=names, handleInvalid="keep").transform(flat)
    if pieces > 1:
        flat = flat.withColumn("piece", F.pmod(F.xxhash64("label", *[f"x{j}" for j in range(width)]), F.lit(pieces)))
    keys = [*names, *keep, *(["piece"] if pieces > 1 else [])]
    ends = [end for j in range(width) for end in (F.min(f"x{j}").alias(f"lo{j}"), F.max(f"x{j}").alias(f"hi{j}"))]
    weight = F.count(F.lit(1)).cast("double").alias("w")
    if mean:
        # A missing label stays a cell of its own, which the learner refuses.
        grouped = flat.groupBy(*keys, F.isnull("label").alias("unknown")).agg(
            weight, F.avg("label").alias("label"), F.stddev_pop("label").alias("spread"), *ends
        )
    else:
        grouped = flat.groupBy(*keys, "label").agg(weight, *ends)
    cells = materialize(grouped, "weighed-rows")
    # Lowest and highest value of each bin, over all its cells: bins * features rows.
    sides = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"b{j}").alias("b"), F.col(f"lo{j}").alias("lo"), F.col(f"hi{j}").alias("hi")) for j in range(width)]))
    bounds = cells.select(sides.alias("s")).groupBy("s.j", "s.b").agg(F.min("s.lo").alias("lo"), F.max("s.hi").alias("hi")).collect()
    # The deviation of a cell matters only to the error that validation watches.
    apart = mean and bool(keep)
    points = 4 if apart else 2
    n_cells = cells.count()
    if 2 * points * n_cells > n_rows:
        return None

    def corner(side: str) -> Column:
        of = lambda j: {row.b: row[side] for row in bounds if row.j == j}
        value = lambda j: F.create_map(*[F.lit(x) for pair in sorted(of(j).items()) for x in pair])[F.col(f"b{j}")]
        return F.array(*[value(j) for j in range(width)])

    labels = [F.col("label") - F.col("spread"), F.col("label") + F.col("spread")] if apart else [F.col("label")]
    spots = [F.struct(y.alias("y"), corner(side).alias("at")) for y in labels for side in ("lo", "hi")]
    # Sorted, so that samples drawn by place agree between runs.
    tasks = max(1, min(data.sparkSession.sparkContext.defaultParallelism, points * n_cells // 20_000))
    dealt = cells.repartition(tasks, *keys).sortWithinPartitions(*keys, "label")
    return dealt.select(F.explode(F.array(*spots)).alias("s"), (F.col("w") / points).alias("weight"), *keep).select(
        F.col("s.y").alias(label), array_to_vector("s.at").alias(features), "weight", *keep
    )


def _boosted(data: DataFrame, estimator, spread: str | None, keep: Sequence[str] = (), mean: bool = False) -> Model:
    """The estimator fitted to weighed cells, or to the rows themselves, spread
    by the unique key ``spread`` if there is one."""
    cells = None
    if not estimator.isSet("weightCol"):
        pieces = PIECES if estimator.getSubsamplingRate() < 1 else 1
        cells = weighed(data, estimator, keep, mean, pieces)
    if cells is None:
        return _ready(balanced(data, spread, estimator.getFeaturesCol()) if spread else data, estimator)
    # A bin has two ends, and cuts between all ends must be open to the learner.
    return _ready(cells, estimator.copy().setWeightCol("weight").setMaxBins(2 * estimator.getMaxBins()))


def random_forest(data: DataFrame, seed: int = 1, **settings) -> Model:
    return _ready(data, RandomForestClassifier(seed=seed, **{**FOREST, **settings}))


def boosted_classifier(data: DataFrame, seed: int = 1, spread: str | None = None, **settings) -> Model:
    return _boosted(data, GBTClassifier(seed=seed, **{**BOOSTED_CLASSIFIER, **settings}), spread)


def boosted_classifier_validated(data: DataFrame, valid: str, seed: int = 1, spread: str | None = None, **settings) -> Model:
    """Stops when the error on rows with ``valid`` true no longer falls."""
    return _boosted(data, GBTClassifier(seed=seed, validationIndicatorCol=valid, **{**BOOSTED, **settings}), spread, [valid])


def boosted_regressor_validated(data: DataFrame, valid: str, seed: int = 1, spread: str | None = None, **settings) -> Model:
    return _boosted(data, GBTRegressor(seed=seed, validationIndicatorCol=valid, **{**BOOSTED, **settings}), spread, [valid], mean=True)


def gradient_classifier(data: DataFrame, seed: int = 1, spread: str | None = None, **settings) -> Model:
    """Logistic boosting with a larger step and deeper trees."""
    return _boosted(data, GBTClassifier(seed=seed, **{**GRADIENT_CLASSIFIER, **settings}), spread)


def gradient_regressor(data: DataFrame, seed: int = 1, spread: str | None = None, **settings) -> Model:
    """Many small steps on row samples. ``minInfoGain`` is the least gain of a
    split; there is no L1 term in this learner.

    Hundreds of trees are grown in one stage (:mod:`stepped`); settings that it does
    not know, and rows that Spark's learner refuses, are left to that."""
    estimator = GBTRegressor(seed=seed, **{**GRADIENT_REGRESSOR, **settings})
    return _stepped(data, estimator, spread) or _boosted(data, estimator, spread, mean=True)


def _stepped(data: DataFrame, estimator: GBTRegressor, key: str | None) -> Model | None:
    if not stepped.can_fit(estimator):
        return None
    features = vector_to_array(estimator.getFeaturesCol())
    some = data.select(F.size(features)).first()
    width = some[0] if some else 0
    if not 0 < (width or 0) <= MOST_GROUPED:
        return None
    rows = data.select(F.col(estimator.getLabelCol()).cast("double").alias("label"), features.alias("x"), *([F.col(key).alias("key")] if key else []))
    piece = F.pmod(F.xxhash64(*(["key"] if key else ["label", "x"])), F.lit(stepped.PIECES))
    names = [f"x{j}" for j in range(width)]
    sized = F.when(F.size("x") == width, F.col("x"))
    # Written once, as plain columns: they are read for the bins and for the cells.
    flat = rows.select("label", *[F.get(sized, F.lit(j)).alias(name) for j, name in enumerate(names)], piece.cast("tinyint").alias("piece"))
    flat = materialize(flat, "training-rows")
    cuts, n_rows, plain = _cuts(flat.select("label", F.array(*names).alias("x")), width, estimator.getMaxBins())
    return stepped.fit(flat, cuts, estimator) if n_rows and plain else None


def logistic(data: DataFrame, **settings) -> Model:
    return _ready(data, LogisticRegression(**{**LOGISTIC, **settings}))


def clusters(data: DataFrame, **settings) -> Model:
    return _ready(data, KMeans(**{**CLUSTERS, **settings}))


def scored(model: Model, data: DataFrame, key: str, *keep: str) -> DataFrame:
    """(key, kept columns, prediction) and, for classifiers, the probability
    of class 1."""
    result = model.transform(data)
    columns = [F.col(key), *[F.col(name) for name in keep], F.col("prediction").cast("double").alias("prediction")]
    if "probability" in result.columns:
        columns.append(vector_to_array("probability")[1].alias("probability"))
    return result.select(*columns)


def save_model(model: Model, path: str) -> None:
    """Save, replacing what is at the path."""
    model.write().overwrite().save(path)


def load_model(kind: type, path: str) -> Model:
    return kind.load(path)


def error_report(scores: DataFrame, part: str = "split", label: str = "label") -> DataFrame:
    """Rows, RMSE and the RMSE of always saying the mean, per part."""
    error = F.col(label) - F.col("prediction")
    return scores.groupBy(part).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(error * error)).alias("rmse"), F.stddev_pop(label).alias("rmse_of_mean")
    )


def centre_rows(model: Model, data: DataFrame) -> DataFrame:
    """(cluster, centre): one row for each of the model's k clusters."""
    rows = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
    return data.sparkSession.createDataFrame(rows, "cluster int, centre array<double>")


def objective_rows(model: Model, data: DataFrame) -> DataFrame:
    """(step, objective): the value after each step of a logistic model."""
    rows = [(i, float(x)) for i, x in enumerate(model.summary.objectiveHistory)]
    return data.sparkSession.createDataFrame(rows, "step int, objective double")


def classifier_report(scores: DataFrame, part: str = "split", threshold: float = 0.5) -> DataFrame:
    """(part, metric, value): rows, confusion counts, accuracy, recall,
    precision and F1 of scored rows (label, probability), per part, in one pass."""
    hit, positive = F.col("probability") >= threshold, F.col("label") == 1
    count = lambda condition: F.count_if(condition).cast("double")
    counts = {"tp": count(hit & positive), "fp": count(hit & ~positive), "tn": count(~hit & ~positive), "fn": count(~hit & positive)}
    grouped = scores.groupBy(part).agg(*[value.alias(name) for name, value in counts.items()])
    tp, fp, tn, fn = (F.col(name) for name in counts)
    measures = {
        "rows": tp + fp + tn + fn,
        **{name: F.col(name) for name in counts},
        "accuracy": F.try_divide(tp + tn, tp + fp + tn + fn),
        "recall": F.try_divide(tp, tp + fn),
        "precision": F.try_divide(tp, tp + fp),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
    }
    cells = F.array(*[F.struct(F.lit(name).alias("metric"), value.alias("value")) for name, value in measures.items()])
    return grouped.select(part, F.explode(cells).alias("m")).select(part, "m.*")


def cluster_report(model: Model, data: DataFrame) -> DataFrame:
    """(cluster, rows, squared_error, centre): the squared distance of each
    cluster's rows to its centre, added up from the rows."""
    value = vector_to_array("features")
    centres = F.lit([[float(x) for x in c] for c in model.clusterCenters()])  # k short lists
    placed = model.transform(data).select(F.col("prediction").alias("cluster"), value.alias("v"))
    gap = F.zip_with("v", F.get(centres, F.col("cluster")), lambda a, b: (a - b) * (a - b))
    cost = placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.aggregate(gap, F.lit(0.0), lambda s, d: s + d)).alias("squared_error")
    )
    return cost.join(F.broadcast(centre_rows(model, data)), "cluster")


def fit_report(model: Model, data: DataFrame) -> DataFrame:
    """(kind, step, x, y) of a logistic model: the objective after each step,
    and the ROC points of its training rows."""
    history = objective_rows(model, data).select(F.lit("objective").alias("kind"), F.col("step").cast("double").alias("x"), F.col("objective").alias("y"))
    return history.union(model.summary.roc.select(F.lit("roc"), "FPR", "TPR"))
