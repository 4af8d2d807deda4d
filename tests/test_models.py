"""Properties of fitted models; exact scores belong to the learner."""

import pytest
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerleaf.operators import dictionary, evaluate, models
from ledgerleaf.operators.labels import split_by_hash
from ledgerleaf.scratch import fresh_path


@pytest.fixture(scope="module")
def data(spark):
    a, b = F.rand(1), F.rand(2)
    rows = spark.range(1500).select("id", a.alias("a"), b.alias("b")).withColumns(
        {
            "label": F.when(F.col("a") + F.col("b") > 1, 1.0).otherwise(0.0),
            "target": F.col("a") * 10 + F.col("b"),
            "features": array_to_vector(F.array("a", "b")),
        }
    )
    split = split_by_hash(rows, "id", {"train": 0.6, "valid": 0.2, "test": 0.2})
    return split.withColumn("is_valid", F.col("split") == "valid").cache()


def fit_rows(data):
    return models.balanced(data.filter("split <> 'test'"), "id")


def area(model, data):
    scored = models.scored(model, data.filter("split = 'test'"), "id", "label")
    assert scored.filter("probability < 0 or probability > 1").count() == 0
    assert scored.count() == data.filter("split = 'test'").count()
    return evaluate.auc_exact(scored.select(F.col("probability").alias("score"), "label")).first()[0]


def test_classifiers_separate_the_classes(data):
    rows = fit_rows(data)
    assert area(models.random_forest(rows), data) > 0.9
    assert area(models.boosted_classifier(rows, maxIter=5), data) > 0.9
    assert area(models.boosted_classifier_validated(rows, "is_valid", maxIter=4), data) > 0.9
    assert area(models.gradient_classifier(rows, maxIter=4), data) > 0.9


def test_standing_settings():
    assert models.BOOSTED["maxIter"] == 100 and models.GRADIENT_REGRESSOR["maxIter"] == 400


def spread(model, data):
    scored = models.scored(model, data.filter("split = 'test'"), "id", "target")
    error = F.col("target") - F.col("prediction")
    return scored.agg(F.sqrt(F.avg(error * error)), F.stddev_pop("target")).first()


def test_regressors_beat_the_mean(data):
    rows = fit_rows(data)
    for model in (
        models.boosted_regressor_validated(rows, "is_valid", labelCol="target", maxIter=5),
        models.gradient_regressor(rows, labelCol="target", maxIter=5),
    ):
        rmse, deviation = spread(model, data)
        assert rmse < deviation


def test_logistic_history_and_area(data):
    weak = models.logistic(data, regParam=0.01)
    assert weak.summary.areaUnderROC > 0.9
    history = weak.summary.objectiveHistory
    assert history[-1] < history[0]
    assert models.logistic(data).getRegParam() == 0.3


def test_clusters(data):
    model = models.clusters(data)
    assert len(model.clusterCenters()) == 2 and model.summary.trainingCost > 0
    assert models.scored(model, data, "id").select("prediction").distinct().count() == 2


def test_saved_model_scores_the_same(spark, data, rows):
    model = models.boosted_classifier(fit_rows(data), maxIter=2)
    path = fresh_path(spark, "model")
    for _ in range(2):
        models.save_model(model, path)
    loaded = models.load_model(GBTClassificationModel, path)
    assert rows(models.scored(model, data, "id")) == rows(models.scored(loaded, data, "id"))


def test_reports_hold_the_measures(spark, data):
    """Each number against a second computation from the scores."""
    model = models.random_forest(fit_rows(data))
    scores = models.scored(model, data, "id", "split", "label")
    got = {(r.split, r.metric): r.value for r in models.classifier_report(scores).collect()}
    for part in ("train", "valid", "test"):
        mine = scores.filter(F.col("split") == part).select(F.col("probability").alias("score"), "label")
        ratios, counts = evaluate.ratios(mine).first(), evaluate.confusion(mine).first()
        assert [got[part, m] for m in ("tp", "fp", "tn", "fn")] == [counts.tp, counts.fp, counts.tn, counts.fn]
        for name in ("accuracy", "recall", "precision", "f1"):
            assert got[part, name] == pytest.approx(ratios[name])

    model = models.clusters(data)
    report = models.cluster_report(model, data).collect()
    assert sum(r.squared_error for r in report) == pytest.approx(model.summary.trainingCost)
    assert sum(r.rows for r in report) == 1500 and all(len(r.centre) == 2 for r in report)

    model = models.logistic(data, regParam=0.01)
    rows = models.fit_report(model, data).collect()
    history = [r.y for r in rows if r.kind == "objective"]
    assert history == model.summary.objectiveHistory and history[-1] < history[0]
    points = sorted((r.x, r.y) for r in rows if r.kind == "roc")
    area = sum((b[0] - a[0]) * (b[1] + a[1]) / 2 for a, b in zip(points, points[1:]))
    exact = evaluate.auc_exact(models.scored(model, data, "id", "label").select(F.col("probability").alias("score"), "label")).first()[0]
    assert area == pytest.approx(exact, abs=0.01)


def test_learners_run_after_a_dictionary(spark):
    """Fitting a dictionary leaves nothing in the session that tasks cannot take."""
    rows = spark.range(300).select("id", F.concat(F.lit("p"), F.col("id") % 3).alias("part"), (F.col("id") % 2).cast("double").alias("label"))
    assert dictionary.fit_dictionary(rows.drop("label"), ignore=["id"]).filter("label is not null").count() == 3
    rows = rows.withColumn("features", array_to_vector(F.array(F.col("id").cast("double"), F.rand(1))))
    assert models.scored(models.random_forest(models.balanced(rows, "id")), rows, "id").count() == 300
    assert models.logistic(rows).summary.areaUnderROC >= 0.5


def test_boosted_trees_learn_from_weighed_cells(spark, monkeypatch):
    """The learner gets fewer rows, of the same weight and sums, and grows the
    trees that it grows from the rows."""
    rows = spark.range(6000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    rows = rows.withColumns({"label": (F.col("a") * F.col("b") > 9).cast("double"), "target": F.col("a") * 2 - F.col("b") + F.col("id") % 3})
    rows = rows.withColumns({"features": array_to_vector(F.array("a", "b")), "is_valid": F.col("id") % 4 == 0})
    given, ready = [], models._ready
    monkeypatch.setattr(models, "_ready", lambda data, estimator: given.append(data) or ready(data, estimator))
    fits = (
        lambda: models.gradient_classifier(rows, maxIter=3),
        lambda: models.boosted_regressor_validated(rows, "is_valid", labelCol="target", maxIter=3, stepSize=0.5),
        lambda: models.gradient_regressor(rows, labelCol="target", maxIter=3),
    )
    grouped = [fit() for fit in fits]
    for data, label in zip(given, ("label", "target", "target")):
        got = data.agg(F.count(F.lit(1)), F.sum("weight"), F.sum(F.col("weight") * F.col(label))).first()
        assert got[0] <= 3000 and got[1] == pytest.approx(6000) and got[2] == pytest.approx(rows.agg(F.sum(label)).first()[0])
    square = given[1].agg(F.sum(F.col("weight") * F.col("target") ** 2)).first()[0]
    assert square == pytest.approx(rows.agg(F.sum(F.col("target") ** 2)).first()[0])
    monkeypatch.setattr(models, "weighed", lambda *args: None)
    for model, plain in zip(grouped[:2], [fit() for fit in fits[:2]]):
        both = models.scored(model, rows, "id").join(models.scored(plain, rows, "id").select("id", F.col("prediction").alias("other")), "id")
        assert both.filter(F.abs(F.col("prediction") - F.col("other")) > 1e-9).count() == 0


def test_rows_that_share_no_cell_stay_rows(spark):
    rows = spark.range(400).select(F.rand(1).alias("label"), array_to_vector(F.array(F.rand(2), F.rand(3), F.rand(4))).alias("features"))
    assert models.weighed(rows, models.GBTRegressor(), mean=True) is None
    assert models.weighed(rows.limit(0), models.GBTRegressor(), mean=True) is None


def test_a_task_holds_no_more_of_a_larger_table(spark, monkeypatch):
    """Training rows are dealt over tasks by their number and width, wherever the
    learner's rows lie; each row comes once."""
    monkeypatch.setattr(models, "TASK_NUMBERS", 20_000, raising=False)
    made = F.array(*[F.rand(k) for k in range(4)])
    for n in (10_000, 40_000):
        rows = spark.range(n).select("id", (F.col("id") % 2).cast("double").alias("label"), array_to_vector(made).alias("features"))
        dealt = models.balanced(rows, "id").groupBy(F.spark_partition_id().alias("part")).agg(F.count("id").alias("n"), F.sum("id").alias("s")).collect()
        assert max(part.n for part in dealt) <= 1_300
        assert sum(part.n for part in dealt) == n and sum(part.s for part in dealt) == n * (n - 1) // 2
    few = models.balanced(rows.limit(50), "id")
    assert few.rdd.getNumPartitions() == 1 and few.count() == 50
    assert models.balanced(rows.limit(0), "id").count() == 0
