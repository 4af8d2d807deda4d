"""Measures against brute force on small score tables."""

import itertools
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import evaluate
from ledgerleaf.sources import scores


def half_up(x, k):
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-k), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(5)
    data = []
    for _ in range(400):
        label = 1.0 if rng.random() < 0.3 else 0.0
        score = min(max(rng.gauss(0.35 + 0.25 * label, 0.2), 0.0), 1.0)
        # A third of the rows share one score; others sit on rounding ties.
        score = 0.125 if rng.random() < 0.33 else round(score, rng.choice([2, 3, 4, 7]))
        data.append((score, label))
    return data


@pytest.fixture(scope="module")
def scored(spark, pairs):
    return spark.createDataFrame(pairs, "score double, label double")


def counts(pairs, test):
    return sum(1 for s, y in pairs if y == 1 and test(s)), sum(1 for s, y in pairs if y == 0 and test(s))


def brute_ks(pairs):
    p, n = counts(pairs, lambda s: True)
    points = {}
    for t in {half_up(s, 2) for s, _ in pairs}:
        cp, cn = counts(pairs, lambda s, t=t: s <= t)
        points[t] = (cn / n, cp / p)
    return points


def brute_roc(pairs, k):
    p, n = counts(pairs, lambda s: True)
    points = set()
    for t in {half_up(s, k) for s, _ in pairs}:
        cp, cn = counts(pairs, lambda s, t=t: s >= t)
        points.add((half_up(cn / n, k), half_up(cp / p, k)))
    return points


def area(points):
    walk = [(0.0, 0.0), *sorted(points), (1.0, 1.0)]
    return sum((b[1] + a[1]) * (b[0] - a[0]) / 2 for a, b in itertools.pairwise(walk))


@pytest.mark.parametrize("unit", [True, False])
def test_ks(scored, pairs, unit):
    want = brute_ks(pairs)
    got = {r.threshold: (r.neg_ratio, r.pos_ratio) for r in evaluate.ks_points(scored, unit_scores=unit).collect()}
    assert got.keys() == want.keys()
    assert [x for t in sorted(got) for x in got[t]] == pytest.approx([x for t in sorted(want) for x in want[t]])
    ks = evaluate.ks(scored, unit_scores=unit).first()[0]
    assert ks == pytest.approx(max(abs(a - b) for a, b in want.values()))


@pytest.mark.parametrize("unit", [True, False])
def test_rounded_roc(scored, pairs, unit):
    want = brute_roc(pairs, 3)
    assert {(r.fpr, r.tpr) for r in evaluate.roc_points(scored, unit_scores=unit).collect()} == want
    assert evaluate.auc_rounded(scored, unit_scores=unit).first()[0] == pytest.approx(area(want))


def test_scores_outside_the_unit_interval(spark):
    wide = spark.createDataFrame([(-3.14159, 0.0), (12.71, 1.0), (12.709, 0.0), (99.0, 1.0)], "score double, label double")
    with pytest.raises(Exception, match="outside"):
        evaluate.ks(wide).collect()
    assert evaluate.ks(wide, unit_scores=False).first()[0] == pytest.approx(0.5)


def test_exact_area(scored, pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    want = wins / (len(pos) * len(neg))
    assert evaluate.auc_exact(scored).first()[0] == pytest.approx(want)
    points = evaluate.roc_exact(scored)
    assert evaluate.area_under_points(points, "fpr", "tpr").first()[0] == pytest.approx(want)
    assert evaluate.area_under_points(points, "fpr", "tpr", gridded=True).first()[0] == pytest.approx(want)


def test_precision_recall_against_the_library(spark, scored, pairs):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert evaluate.auc_exact(scored).first()[0] == pytest.approx(judge.evaluate(scored))
    judge.setMetricName("areaUnderPR")
    assert evaluate.area_under_precision_recall(scored).first()[0] == pytest.approx(judge.evaluate(scored))
    for row in evaluate.precision_recall(scored).collect():
        tp, fp = counts(pairs, lambda s, t=row.threshold: s >= t)
        assert row.precision == pytest.approx(tp / (tp + fp))


def test_confusion_and_ratios(scored, pairs):
    row = evaluate.confusion(scored, 0.5).first()
    tp, fp = counts(pairs, lambda s: s >= 0.5)
    fn, tn = counts(pairs, lambda s: s < 0.5)
    assert (row.tp, row.fp, row.fn, row.tn, row.total) == (tp, fp, fn, tn, len(pairs))
    ratios = evaluate.ratios(scored).first()
    precision, recall = tp / (tp + fp), tp / (tp + fn)
    assert ratios.f1 == pytest.approx(2 * precision * recall / (precision + recall))
    f2 = {r.beta: r.f_beta for r in evaluate.f_beta(scored, [1.0, 2.0]).collect()}
    assert f2[1.0] == pytest.approx(ratios.f1)
    assert f2[2.0] == pytest.approx(5 * precision * recall / (4 * precision + recall))


def test_empty_denominators_give_null(spark):
    only_negative = spark.createDataFrame([(0.1, 0.0), (0.2, 0.0)], "score double, label double")
    row = evaluate.ratios(only_negative).first()
    assert row.recall is None and row.precision is None and row.f1 is None and row.fpr == 0.0
    assert evaluate.auc_exact(only_negative).first()[0] is None
    assert evaluate.ks(only_negative).first()[0] is None


def test_errors(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.0, 0.0), (1.0, 0.0)], "score double, label double")
    assert evaluate.rmse(df).first()[0] == pytest.approx(math.sqrt(1.25 / 3))
    row = evaluate.error_statistics(df).first()
    assert (row.error_mean, row.mean_absolute_error, row.squared_error) == pytest.approx((-1 / 6, 0.5, 1.25))


def test_label_counter_takes_half_as_positive(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (1.0,), (-1.0,)], "label double")
    assert tuple(evaluate.label_counts(df).first()) == (2, 2)


def test_dcg_with_one_dominant_query(spark):
    rng = random.Random(3)
    data = [(0 if i % 3 else i, i, rng.randint(0, 3)) for i in range(300)]
    df = spark.createDataFrame(data, "q int, at int, rel int")

    def gain(rels):
        return sum(r if i == 1 else r / math.log2(i) for i, r in enumerate(rels, 1))

    got = {r.q: r.dcg for r in evaluate.dcg(df, "q", "rel", ["at"]).collect()}
    norm = {r.q: r.ndcg for r in evaluate.ndcg(df, "q", "rel", ["at"], "at").collect()}
    for q in {d[0] for d in data}:
        rels = [r for g, _, r in sorted(data, key=lambda d: d[1]) if g == q]
        best = gain(sorted(rels, reverse=True))
        assert got[q] == pytest.approx(gain(rels))
        assert norm[q] == (pytest.approx(gain(rels) / best) if best else None)


def test_bands(scored, pairs):
    rows = sorted(evaluate.ks_bands(scored).collect())
    assert sum(r.pos + r.neg for r in rows) == len(pairs)
    assert rows[-1].cum_pos == sum(1 for _, y in pairs if y == 1)


@pytest.mark.parametrize(
    "population,auc,error", [("good", 0.8621, 0.4218), ("mid", 0.6912, 0.5567), ("bad", 0.5831, 0.6303)]
)
def test_published_measures_of_the_generated_populations(spark, population, auc, error):
    """100,000 negatives and 2,000 positives; the published draw had no seed.

    The gap of two normal distributions with the same variance is greatest
    half-way between their means, which gives the expected KS.
    """
    (low, variance), (high, _) = scores.POPULATIONS[population]
    gap = math.erf((high - low) / (2 * math.sqrt(2 * variance)))
    table = scores.generate_scores(spark, population).cache()
    assert evaluate.auc_rounded(table).first()[0] == pytest.approx(auc, abs=0.02)
    assert evaluate.ks(table).first()[0] == pytest.approx(gap, abs=0.03)
    assert evaluate.rmse(table).first()[0] == pytest.approx(error, abs=0.01)
    table.unpersist()


def test_uniform_fixtures(spark):
    table = scores.generate_uniform_scores(spark, 4000)
    row = table.agg(F.avg("score"), F.avg("label"), F.min("label"), F.max("label")).first()
    assert abs(row[0] - 0.5) < 0.02 and abs(row[1] - 0.5) < 0.03 and (row[2], row[3]) == (0, 1)
    matrix = scores.generate_matrix(spark, 100, 11)
    assert len(matrix.columns) == 11 and matrix.filter("c3 < 0 or c3 > 10").count() == 0
    assert scores.uniform_labels(spark.range(5), "id").filter("label > 0 and label < 1").count() == 5


def test_generated_populations_are_ordered_by_quality(spark):
    areas = [
        evaluate.auc_rounded(scores.generate_scores(spark, name, 5000, 500)).first()[0]
        for name in ("good", "mid", "bad")
    ]
    assert areas[0] > areas[1] > areas[2] > 0.5
    table = scores.generate_scores(spark, "good", 50, 7)
    assert table.agg(F.sum("label")).first()[0] == 7.0 and table.count() == 57
    assert scores.generate_regression_pairs(spark, 10, (0.5, 0.1), (0.8, 0.05)).count() == 10
