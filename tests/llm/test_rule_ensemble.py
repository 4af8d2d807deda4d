import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import rule_ensemble as re_

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def trained(spark):
    return re_.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, trained):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = re_.score_texts(docs.join(labels, "doc_id"), trained, ["doc_id", "quality"]).collect()
    rows = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    score, y = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    ranks = score.argsort().argsort()
    assert len(rows) > 1000 and (ranks[y == 1].mean() - ranks[y == 0].mean()) / len(y) + 0.5 > 0.98
    assert (score[y == 1] >= 0.5).mean() > 0.99 and (score[y == 0] < 0.5).mean() > 0.95


def test_rules_are_few_and_readable(trained):
    names = list(re_.statistics(F.lit("")))
    assert 3 <= len(trained.rules) <= 200 and all(w for w in trained.weights)
    assert all(any(name in rule.says(names) for name in names) for rule in trained.rules)


def test_the_column_equals_the_rules_in_numpy(spark, trained, documents):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = rows.unionByName(documents([(-1, None), (-2, ""), (-3, "word " * 300_000)]).select("doc_id", "text"))
    stats = re_.statistics(F.col("text"))
    x = {r[0]: r[1:] for r in rows.select("doc_id", *[c.alias(n) for n, c in stats.items()]).collect()}
    got = {r.doc_id: r.score for r in re_.score_texts(rows, trained, ["doc_id"]).collect()}
    ids = sorted(x)
    assert [got[i] for i in ids] == pytest.approx(trained.scores(np.array([x[i] for i in ids], float)).tolist(), abs=1e-12)


def test_scoring_runs_without_python_or_shuffle(spark, trained, documents):
    scored = re_.score_texts(documents([(1, "a")]), trained, ["doc_id"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_statistics(spark):
    text = "Ab, CD 12\r\nab. ab?\n\n- (x) $$ été"
    got = spark.createDataFrame([(text,), ("",), (None,)], "t string").select(*[c.alias(n) for n, c in re_.statistics(F.col("t")).items()]).collect()
    words, lines = text.split(), text.split("\n")
    assert got[0].chars == len(text) and got[0].words == len(words) == 9
    assert got[0].distinct_words == len(set(words)) / 9 and got[0].distinct_lines == len(set(lines)) / len(lines) == 1.0
    assert got[0].capitals == pytest.approx(3 / len(text)) and got[0].digits == pytest.approx(2 / len(text))
    assert got[0].signs == pytest.approx(2 / len(text)) and got[0].short_words == pytest.approx(9 / 9)
    assert got[0].item_lines == 1 / 4 and got[0].stops == pytest.approx(2 / 9)
    assert got[1] == got[2] and sum(got[1][n] for n in ("chars", "words", "capitals")) == 0


def test_paths_of_a_tree_become_conjunctions():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.3)).astype(float)
    model = re_.RuleEnsemble.fit(x, y, np.ones(2000), rng.random(2000) < 0.3)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97
    for rule in model.rules:
        assert len({j for j, _, _ in rule.bounds}) == len(rule.bounds) <= re_.DEPTH
        assert all(low < high for _, low, high in rule.bounds)


def test_lasso_reaches_the_optimum_and_empties_with_the_penalty():
    rng = np.random.default_rng(4)
    x = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 1])))).astype(float)
    weight = np.full(400, 1 / 400)
    w = re_.lasso_logistic(x, y, weight, 0.01)
    slope = x.T @ (weight * (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y))
    assert np.all(np.abs(slope[w[:-1] != 0] + 0.01 * np.sign(w[:-1][w[:-1] != 0])) < 1e-4)
    assert np.all(np.abs(slope[w[:-1] == 0]) <= 0.01 + 1e-4) and w[0] > 0 > w[1]
    assert not np.any(re_.lasso_logistic(x, y, weight, 1.0)[:-1])


def test_labels_of_the_held_out_fold_are_not_read(spark, documents):
    docs = documents([(i, f"text {i} {'!!' * (i % 2)}") for i in range(200)])
    make = lambda flip: spark.createDataFrame(
        [(i, (1 - i % 2) if flip and zlib.crc32(str(i).encode()) % 3 == 1 else i % 2) for i in range(200)], "doc_id bigint, quality int"
    )
    sample = lambda flip: re_.labelled_statistics(docs, make(flip), "quality", "text", "doc_id", 50)
    assert sample(False)[0] == sample(True)[0]


def test_the_sample_is_bounded_and_does_not_move_the_balance(spark, documents):
    """Copies of an identifier count once; few fitted rows keep the table's class balance."""
    rows = [(i, "good words here" if i % 10 else "BAD $$") for i in range(3000)] + [(1, "good words here")] * 500
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(3000)], "doc_id bigint, quality int")
    got, totals = re_.labelled_statistics(documents(rows), labels, "quality", "text", "doc_id", 60)
    assert len(got) == len({r[0] for r in got}) and 100 <= len(got) <= 120
    assert totals[1] == sum(1 for i in range(3000) if i % 10 and zlib.crc32(str(i).encode()) % 3 != 1)
    plain = documents([(i, "same") for i in range(3000)])
    model = re_.train(plain, labels, most=60)
    assert {round(r.score, 2) for r in re_.score_texts(plain, model, ["doc_id"]).collect()} == {round(totals[1] / (totals[0] + totals[1]), 2)}


def test_nulls_names_and_missing_labels(spark, documents):
    docs = documents([(1, None), (None, "a"), (1, ""), (2, "x y")], extra=("score", "row", "s_chars", "content", "id"))
    none = spark.createDataFrame([(None, 1), (1, None), (9, 0), (2, 7)], "doc_id bigint, quality int")
    model = re_.train(docs, none)
    scored = re_.score_texts(docs, model, docs.columns, into="made")
    assert scored.columns == [*docs.columns, "made"] and {r.made for r in scored.collect()} == {0.5}
    assert re_.score_texts(documents([]), model, ["doc_id"]).count() == 0
