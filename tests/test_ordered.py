"""Row numbers and running sums over many parts, with one very large group."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerleaf.operators.ordered import numbered, running, with_preceding


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 0 holds more than a third of all rows; some keys are missing."""
    n = F.col("id")
    group = F.when(n % 5 < 2, 0).when(n % 97 == 4, F.lit(None)).otherwise(n % 50)
    return spark.range(6000).select(group.cast("int").alias("g"), ((n * 7919) % 6007).alias("o"), (n % 11).alias("x"))


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_grouped_running_sum_equals_window(skewed, rows, parts):
    w = Window.partitionBy("g").orderBy("o")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("g", "o", F.sum("x").over(so_far).alias("s"), F.row_number().over(w).cast("bigint").alias("n"))
    got = running(skewed, ["o"], group_by=["g"], totals={"s": "x"}, row_number="n", parts=parts)
    assert rows(got, "g", "o", "s", "n") == rows(want)


def test_descending_order_and_overall_sum(skewed, rows):
    w = Window.orderBy(F.desc("o"))
    want = skewed.select("o", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = running(skewed, [F.desc("o")], totals={"s": "x"}, overall={"all": "x"}, parts=7)
    assert rows(got, "o", "s") == rows(want)
    assert got.select("all").distinct().collect()[0][0] == skewed.agg(F.sum("x")).first()[0]


def test_position_is_dense(skewed):
    got = numbered(skewed, ["o"], parts=9)
    assert sorted(row.line_no for row in got.collect()) == list(range(1, 6001))


def test_empty_table(skewed):
    assert numbered(skewed.filter("x < 0"), ["o"]).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 60])
@pytest.mark.parametrize("order", ["asc", "asc_nulls_last", "desc", "desc_nulls_first"])
def test_every_order_and_missing_values(spark, rows, order, parts):
    """Text, times and numbers, falling and rising, with nulls at either end."""
    n = F.col("id")
    df = spark.range(800).select(
        F.when(n % 9 == 1, F.lit(None)).otherwise(F.concat(F.lit("t"), n % 7)).alias("t"),
        F.when(n % 13 == 2, F.lit(None)).otherwise(F.timestamp_seconds(n % 5 * 100_000)).alias("at"),
        (n * 31 % 801).cast("double").alias("d"),
    )
    by = [getattr(F.col("t"), order)(), getattr(F.col("at"), order)(), getattr(F.col("d"), order)()]
    want = df.select("*", F.row_number().over(Window.orderBy(*by)).cast("bigint").alias("n"))
    assert rows(numbered(df, by, name="n", parts=parts)) == rows(want)


def test_only_named_columns_order(spark):
    with pytest.raises(ValueError):
        numbered(spark.range(3), [(F.col("id") * 2).desc()])


@pytest.mark.parametrize("parts", [1, 2, 30])
def test_the_row_before_is_handed_over(skewed, rows, parts):
    df = skewed.select("g", "o")
    w = Window.orderBy(F.col("g").asc_nulls_first(), "o")
    want = df.select("g", "o", F.lag(F.struct("g", "o")).over(w).alias("b"))
    assert rows(with_preceding(df, ["g", "o"], "b", parts=parts)) == rows(want)
    assert with_preceding(df.filter("o < 0"), ["g", "o"], "b", parts=parts).count() == 0
