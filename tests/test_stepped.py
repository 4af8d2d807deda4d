"""Trees grown over cells are those of Spark's learner, with few jobs for each."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerleaf.operators import cell_trees, models, stepped
from ledgerleaf.scratch import fresh_path


@pytest.fixture(scope="module")
def data(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 11).cast("double").alias("c"))
    target = F.col("a") * F.col("b") - F.col("c") * F.col("c") + F.rand(3)
    return rows.select("id", target.alias("label"), array_to_vector(F.array("a", "b", "c")).alias("features")).cache()


def predictions(model, data):
    return {row.id: row.prediction for row in models.scored(model, data, "id").collect()}


@pytest.mark.parametrize("pairs", [cell_trees.MOST_PAIRED, 0])
def test_trees_are_those_of_sparks_learner(data, monkeypatch, pairs):
    monkeypatch.setattr(cell_trees, "MOST_PAIRED", pairs)
    settings = {"subsamplingRate": 1.0, "maxIter": 12, "stepSize": 0.3}
    mine = models.gradient_regressor(data, **settings)
    assert isinstance(mine, stepped.SteppedModel) and mine.getNumTrees() == 12
    plain = models.GBTRegressor(seed=1, **{**models.GRADIENT_REGRESSOR, **settings}).fit(data)
    got, expected = predictions(mine, data), predictions(plain, data)
    assert len(got) == 4000 and all(got[k] == pytest.approx(v, abs=1e-6) for k, v in expected.items())
    # Values that no bin holds fall on the same side of a threshold.
    between = data.select("id", array_to_vector(F.array(F.col("id") % 9 - 0.7, F.col("id") % 6 + 0.4, F.col("id") % 13 + 0.6)).alias("features"))
    got, expected = predictions(mine, between), predictions(plain, between)
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in expected.items())


def test_a_tree_takes_few_jobs(spark, data):
    spark.sparkContext.setJobGroup("stepped", "")
    model = models.gradient_regressor(data, spread="id", maxIter=20)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees() == 20
    # Three for a tree of five levels; the learner before took five and more.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("stepped")) <= 3 * 20 + 20


def test_scores_listed_and_walked_agree_and_models_are_kept(spark, data, monkeypatch):
    model = models.gradient_regressor(data, spread="id", maxIter=5)
    listed = predictions(model, data)
    assert listed == predictions(models.gradient_regressor(data, spread="id", maxIter=5), data)
    path = fresh_path(spark, "model")
    models.save_model(model, path)
    monkeypatch.setattr(cell_trees, "MOST_LISTED", 0)
    assert predictions(models.load_model(stepped.SteppedModel, path), data) == listed


def test_odd_rows_are_refused_as_before(data):
    for odd in (F.lit(None).cast("double"), F.lit(float("nan"))):
        rows = data.withColumn("label", F.when(F.col("id") != 7, F.col("label")).otherwise(odd))
        with pytest.raises(Exception, match="(?i)label"):
            models.gradient_regressor(rows, maxIter=1)
