import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import toxicity as tox

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def trained(spark):
    return tox.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, trained):
    docs = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = [r for r in docs.select("doc_id", "text", "toxic").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    score, y = trained.scores([r.text.encode() for r in rows]), np.array([r.toxic for r in rows])
    ranks = score.argsort().argsort()
    auc = (ranks[y == 1].mean() - ranks[y == 0].mean()) / len(y) + 0.5
    assert auc > 0.95 and ((score >= 0.5) == y).mean() > 0.96


def test_blocks_do_not_change_a_score(trained, monkeypatch):
    texts = [b"", b"one", b"two words " * 700, b"x", b"", b"idiot and more " * 3]
    whole = trained.scores(texts)
    monkeypatch.setattr(tox, "BLOCK_WORDS", 7)
    assert trained.scores(texts) == pytest.approx(whole, abs=1e-6)
    assert [trained.scores([t])[0] for t in texts] == pytest.approx(whole.tolist(), abs=1e-6)


def test_labels_of_the_held_out_fold_are_not_read(spark, documents):
    rows = [(i, f"text {i} {'bad' if i % 2 else 'good'}", "en") for i in range(200)]
    docs = documents(rows)
    make = lambda flip: spark.createDataFrame(
        [(i, (1 - i % 2) if flip and zlib.crc32(str(i).encode()) % 5 == 0 else i % 2) for i in range(200)], "doc_id bigint, toxic int"
    )
    assert tox.labelled_sample(docs, make(False)) == tox.labelled_sample(docs, make(True))


def test_drop_toxic_keeps_columns_and_clean_rows(spark, documents):
    rows = [(i, ("vile " if i % 2 else "kind ") + f"text number {i}", "en" if i % 3 else None) for i in range(300)]
    rows += [(1000, None, None), (1001, "", "en"), (None, "kind text", "en"), (1, "vile text number 1", "en")]
    docs = documents(rows, extra=("score", "row", "whole", "content"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)] + [(None, 1), (5000, None)], "doc_id bigint, toxic int")
    kept = tox.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.collect()}
    assert len([i for i in range(0, 300, 2) if i in left]) >= 147 and len([i for i in range(1, 300, 2) if i in left]) <= 3
    assert {1000, 1001, None} <= left


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    docs = documents([(1, "a", "en"), (2, None, None)])
    assert tox.train(docs, none) is None
    assert tox.drop_toxic(docs, none).count() == 2
    assert tox.drop_toxic(documents([]), none).count() == 0


def noisy(n, rate=0.1, long=0, small=0):
    """Documents whose words overlap between the classes; every ``small``-th is of a small language."""
    rng = np.random.default_rng(5)
    label = (rng.random(n) < rate).astype(int)
    words = [[f"w{k}" for k in rng.integers(0, 40, 6) // (1 + y * rng.integers(0, 2, 6))] for y in label]
    tail = lambda i: " and" * 40 if long and i % long == 0 else ""
    lang = lambda i: "xx" if small and i % small == 0 else "en"
    return [(i, " ".join(w) + tail(i), lang(i)) for i, w in enumerate(words)], [(i, int(y)) for i, y in enumerate(label)]


def test_thresholds_are_set_on_all_labelled_rows(spark, documents, monkeypatch):
    """The best F1 on the whole fold, in its own class balance and with long texts, however few rows are fitted."""
    monkeypatch.setattr(tox, "MAX_LABELLED", 60)
    monkeypatch.setattr(tox, "MAX_CHARS", 100)
    rows, known = noisy(3000, long=4)
    model = tox.train(documents(rows), spark.createDataFrame(known, "doc_id bigint, toxic int"))
    fold = [i for i, _ in known if zlib.crc32(str(i).encode()) % 5 == tox.CALIBRATION]
    score, y = model.scores([rows[i][1].encode() for i in fold]), np.array([known[i][1] for i in fold])
    f1 = lambda cut: 2 * y[score >= cut].sum() / ((score >= cut).sum() + y.sum())
    assert f1(0.5) > max(f1(cut) for cut in score) - 0.01
    assert sum(r.n for r in tox.score_bins(documents(rows), spark.createDataFrame(known, "doc_id bigint, toxic int"), model, [tox.CALIBRATION])) == len(fold)


def test_a_small_language_of_a_large_table_has_its_threshold(spark, documents, monkeypatch):
    """Its labelled rows count in the table, not in the sample that is fitted."""
    monkeypatch.setattr(tox, "MAX_LABELLED", 60)
    rows, known = noisy(4000, rate=0.3, small=20)
    rows += [(i, "w1 w2", None) for i in range(5000, 5200)] + [(6000, "w1", "rare")]
    known += [(i, i % 2) for i in range(5000, 5200)] + [(6000, 1)]
    model = tox.train(documents(rows), spark.createDataFrame(known, "doc_id bigint, toxic int"))
    assert set(model.languages) == {"en", "xx"}
    fold = [i for i, _ in known if i % 20 == 0 and i < 4000 and zlib.crc32(str(i).encode()) % 5 == tox.CALIBRATION]
    score, y = model.scores([rows[i][1].encode() for i in fold]), np.array([known[i][1] for i in fold])
    f1 = lambda cut: 2 * y[score >= cut].sum() / ((score >= cut).sum() + y.sum())
    assert len(fold) >= tox.MIN_PER_LANGUAGE and f1(model.languages["xx"]) > max(f1(cut) for cut in score) - 0.05
    of = lambda lang: tox.threshold(tox.F.lit(lang), model)
    got = spark.range(1).select(*[of(x).alias(str(x)) for x in ("xx", "rare", None)]).first()
    assert tuple(got) == (pytest.approx(model.languages["xx"]), 0.5, 0.5)


def test_one_text_for_each_identifier(spark, documents, monkeypatch):
    """3,000 rows of four identifiers give one text each, and bytes bound the rest."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 > 1][:4]
    rows = [(ids[k % 4], f"text {k % 500}", "en") for k in range(3000)]
    known = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id bigint, toxic int")
    got = tox.labelled_sample(documents(rows), known)
    assert sorted(label for _, label in got) == [0, 0, 1, 1]
    assert got == tox.labelled_sample(documents(rows[::-1]), known)
    monkeypatch.setattr(tox, "MAX_BYTES", 20)
    assert 0 < sum(len(text) for text, _ in tox.labelled_sample(documents(rows), known)) <= 20


def test_best_cut_by_brute_force():
    """Of all thresholds between bins, none has a better F1."""
    rng = np.random.default_rng(8)
    for _ in range(50):
        number = rng.integers(-20, 20, 30)
        n = rng.integers(1, 9, 30)
        toxic = np.minimum(rng.integers(0, 9, 30), n)
        low, high = number / 10, number / 10 + 0.05

        def f1(cut):
            above = low > cut
            return 2 * toxic[above].sum() / max(1, n[above].sum() + toxic.sum())

        cut = tox.best_cut(number, low, high, n, toxic)
        assert f1(cut) >= max(f1(c) for c in np.arange(-3, 3, 0.1) + 0.07) - 1e-12


def test_pooled_scores_by_brute_force(trained):
    """Every window of every filter, one at a time."""
    texts = [b"", b"one", b"some words of a text and words again", b"idiot you vile thing"]
    words = tox.read_words(texts)
    want = np.zeros((len(texts), len(trained.out)))
    for t in range(len(texts)):
        for start in range(words.starts[t], words.starts[t] + words.counts[t]):
            for j, width in enumerate(tox.WIDTHS):
                for f in range(tox.FILTERS):
                    value = float(trained.bias[j][f])
                    for k in range(width):
                        vector = trained.tables[0][words.one[start + k]] + trained.tables[1][words.two[start + k]]
                        value += float(vector @ trained.filters[j][k, :, f])
                    want[t, j * tox.FILTERS + f] = max(want[t, j * tox.FILTERS + f], value)
    assert np.allclose(trained.pooled(words), want, atol=1e-4)


def test_null_identifiers_and_very_long_texts(spark, documents, trained):
    rows = [(None, "kind words", "en"), (1, "word " * 400_000, "en")]
    scored = {r.doc_id: r.score for r in tox.score_column(documents(rows), trained, ["doc_id"]).collect()}
    assert set(scored) == {None, 1} and all(0 <= v <= 1 for v in scored.values())
    held = documents(rows).select(F.coalesce(tox.fold_of(F.col("doc_id")) == tox.HELD_OUT, F.lit(False)).alias("h")).collect()
    assert held[0].h is False
