"""Regularised boosting against a plain exhaustive version on the same bins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import boosting


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(6)
    x = rng.random((1200, 3))
    y = np.where(x[:, 0] > 0.6, 5.0, 1.0) + 2 * x[:, 1] + rng.normal(0, 0.2, 1200)
    rows = [(i, float(y[i]), [float(v) if k or i % 50 else None for k, v in enumerate(x[i])]) for i in range(1200)]
    return spark.createDataFrame(rows, "id bigint, label double, features array<double>").repartition(5)


def plain(model, x, y, rounds, depth, eta, alpha, gamma, lam, least):
    """Trees by trying every cut on every node's rows."""
    bins, margin = model.binned(x), np.full(len(y), y.mean())
    shrink = lambda g: np.sign(g) * max(abs(g) - alpha, 0)
    power = lambda g, n: shrink(g) ** 2 / (n + lam)

    def grow(rows, level):
        g, n = (margin - y)[rows].sum(), len(rows)
        best = (gamma, None, None)
        for j in range(bins.shape[1] if level < depth else 0):
            for cut in range(boosting.BINS):
                left = bins[rows, j] <= cut
                a, b = rows[left], rows[~left]
                if min(len(a), len(b)) < max(least, 1):
                    continue
                ga, gb = (margin - y)[a].sum(), (margin - y)[b].sum()
                gain = round((power(ga, len(a)) + power(gb, len(b)) - power(g, n)) / 2, 9)
                if gain > best[0]:
                    best = (gain, a, b)
        if best[1] is None:
            step[rows] = -eta * shrink(g) / (n + lam)
        else:
            grow(best[1], level + 1)
            grow(best[2], level + 1)

    for _ in range(rounds):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 0)
        margin = margin + step
    return margin


@pytest.mark.parametrize("settings", [{"alpha": 0.0, "gamma": 0.0, "lam": 1.0, "least": 1.0}, {"alpha": 3.0, "gamma": 2.0, "lam": 0.5, "least": 30.0}])
def test_equals_exhaustive_search(table, settings, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    given = {k: v for k, v in settings.items() if k != "least"}
    model = boosting.fit(table, "id", rounds=4, depth=3, eta=0.3, subsample=1.0, min_child_weight=settings["least"], **given)
    rows = table.orderBy("id").collect()
    x = np.array([[np.nan if v is None else v for v in r.features] for r in rows])
    want = plain(model, x, np.array([r.label for r in rows]), 4, 3, 0.3, **settings)
    got = {r.id: r.prediction for r in boosting.score(model, table, "id").collect()}
    assert [got[r.id] for r in rows] == pytest.approx(want.tolist(), abs=1e-9)


def test_alpha_gamma_and_child_weight_prune(table):
    grown = lambda **s: boosting.fit(table, "id", **{"rounds": 3, "depth": 4, "eta": 0.3, "alpha": 0.0, "gamma": 0.0, "subsample": 1.0, **s}).n_leaves()
    free = grown()
    assert grown(gamma=20.0) < free and grown(gamma=1e9) <= 3 and grown(min_child_weight=200.0) < free
    assert grown(alpha=100.0) < free and grown(alpha=1e9) == 0


def test_samples_repeat_and_the_mean_is_beaten(table):
    fit = lambda: boosting.fit(table.repartition(3), "id", rounds=12, eta=0.3)
    one, two = fit(), fit()
    errors = boosting.score(one, table, "id", "label").agg(
        F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"), F.stddev_pop("label").alias("sd")
    ).first()
    assert errors.rmse < errors.sd / 2
    assert all(np.array_equal(a.feature, b.feature) and np.allclose(a.value, b.value) for a, b in zip(one.trees, two.trees))


def test_classes_and_tables_without_labels(spark, table):
    classes = table.withColumn("label", (F.col("label") > 4).cast("double"))
    model = boosting.fit(classes, "id", objective="logistic", rounds=5, eta=0.5, gamma=0.0)
    scored = boosting.score(model, classes, "id", "label")
    assert scored.filter("prediction < 0 or prediction > 1").count() == 0
    assert scored.filter((F.col("prediction") > 0.5) == (F.col("label") == 1)).count() > 1100
    none = boosting.fit(table.withColumn("label", F.lit(None)), "id")
    assert not none.trees and not none.bounds
    with pytest.raises(ValueError):
        boosting.fit(table, "id", objective="other")


def test_cells_grow_the_trees_of_their_rows(spark, monkeypatch):
    """Both ways draw the same rows; the levels read cells, which are few."""
    rows = spark.range(3000).select("id", ((F.col("id") % 11) * 2 - F.col("id") % 5).cast("double").alias("label"))
    rows = rows.withColumn("features", F.array((F.col("id") % 11).cast("double"), (F.col("id") % 5).cast("double")))
    seen, histogram = [], boosting._histogram
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "_histogram", lambda drawn, *rest: seen.append(drawn) or histogram(drawn, *rest))
    for data, objective in ((rows, "squared"), (rows.withColumn("label", (F.col("label") > 6).cast("double")), "logistic")):
        monkeypatch.setattr(boosting, "CELL_ROWS", 2)
        one = boosting.fit(data, "id", objective=objective, rounds=3, depth=2, eta=0.3, gamma=0.0)
        assert seen[0].count() <= 55
        monkeypatch.setattr(boosting, "CELL_ROWS", 10**9)
        two = boosting.fit(data, "id", objective=objective, rounds=3, depth=2, eta=0.3, gamma=0.0)
        for a, b in zip(one.trees, two.trees, strict=True):
            assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and np.allclose(a.value, b.value, atol=1e-9)
