"""Truth tables of the four fill rules."""

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import clean

TEXTS = [None, "", "null", "NULL", "-9999", "x"]
NUMBERS = [None, -9999.0, 0.0, 5.0, float("nan"), 1.0]


@pytest.fixture(scope="module")
def dirty(spark):
    data = [(i, t, t, n, None if n is None or n != n else int(n)) for i, (t, n) in enumerate(zip(TEXTS, NUMBERS))]
    return spark.createDataFrame(data, "i int, t string, u string, d double, n int").withColumn(
        "day", F.lit(None).cast("date")
    )


def table(df):
    kept = sorted(df.collect(), key=lambda r: r.i)
    return [r.t for r in kept], [r.u for r in kept], [r.d for r in kept], [r.n for r in kept]


def test_fill_for_labels_touches_chosen_columns(dirty):
    t, u, d, n = table(clean.fill_for_labels(dirty, ["t", "d"]))
    assert t == ["0.0", "0.0", "0.0", "0.0", "-9999", "x"]
    assert u == ["0.0", "", "null", "NULL", "-9999", "x"]
    assert d == [0.0, 0.0, 0.0, 5.0, 0.0, 1.0]
    assert n == [0, -9999, 0, 5, 0, 1]


def test_fill_blank(dirty):
    t, u, d, n = table(clean.fill_blank(dirty))
    assert t == u == ["", "", "", "", "", "x"]
    assert d == [0.0, 0.0, 0.0, 5.0, 0.0, 1.0] and n == [0, 0, 0, 5, 0, 1]


def test_fill_zero(dirty):
    t, _, d, n = table(clean.fill_zero(dirty))
    assert t == ["0.0", "0.0", "0.0", "NULL", "-9999", "x"]
    assert d == [0.0, -9999.0, 0.0, 5.0, 0.0, 1.0] and n == [0, -9999, 0, 5, 0, 1]


def test_fill_zero_and_sentinels(dirty):
    t, _, d, n = table(clean.fill_zero_and_sentinels(dirty))
    assert t == ["0.0", "0.0", "0.0", "0.0", "0", "x"]
    assert d == [0.0, 0.0, 0.0, 5.0, 0.0, 1.0] and n == [0, 0, 0, 5, 0, 1]


def test_zero_to_one_keeps_types_and_other_columns(dirty):
    out = clean.zero_to_one(dirty)
    assert out.dtypes == dirty.dtypes
    t, _, d, n = table(out)
    assert t == TEXTS and d[2] == 1.0 and n == [None, -9999, 1, 5, None, 1]
    assert out.filter("day is null").count() == 6
