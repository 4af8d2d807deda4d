"""Stored partial statistics equal the one-shot summary."""

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import aggregates, statistics
from ledgerleaf.scratch import fresh_path

COLUMNS = ["a", "b"]


@pytest.fixture(scope="module")
def readings(spark):
    n = F.col("id")
    return spark.range(3000).select(
        (1e9 + n % 97).alias("a"), ((n * 7 % 13) - 6.0).alias("b"), (n % 4).alias("w"), F.when(n < 1, 0).otherwise(1 + n % 5).alias("day")
    )


def close(got, want):
    got, want = ({r.column: r.asDict() for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for column, row in want.items():
        for name, value in row.items():
            assert got[column][name] == (value if isinstance(value, str) else pytest.approx(value, rel=1e-7)), (column, name)


@pytest.mark.parametrize("weight", [None, "w"])
def test_merged_parts_equal_one_pass(readings, weight):
    """Values near 10^9 with a spread of some tens; one part has a single row."""
    partials = statistics.partial_statistics(readings, COLUMNS, weight, by=["day"])
    assert partials.filter("column = 'a'").count() == (6 if weight is None else 5)
    close(statistics.statistics_of(partials), aggregates.column_statistics(readings, COLUMNS, weight))


def test_days_are_added_without_reading_older_ones(spark, readings):
    store = fresh_path(spark, "statistics")
    for day in (0, 1, 2, 3, 4, 5, 2):
        mine = readings.filter(F.col("day") == day)
        statistics.add_to_store(statistics.partial_statistics(mine, COLUMNS, "w"), store, str(day))
    close(statistics.stored_statistics(spark, store), aggregates.column_statistics(readings, COLUMNS, "w"))


def test_pairwise_merge(spark, readings):
    halves = [statistics.partial_statistics(readings.filter(c), COLUMNS, "w") for c in ("day < 3", "day >= 3")]
    both = statistics.merged_pair(*halves)
    close(both, statistics.partial_statistics(readings, COLUMNS, "w").select(*both.columns))
    empty = spark.createDataFrame([], statistics.PARTIAL)
    close(statistics.merged_pair(halves[0], empty), halves[0].select(*both.columns))


def test_missing_values_and_weights(spark):
    rows = [(1.0, 1.0), (None, 1.0), (3.0, None), (5.0, 0.0), (2.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, w double")
    row = statistics.statistics_of(statistics.partial_statistics(df, ["a"], "w")).first()
    assert row["count"] == 2 and row.mean == pytest.approx(5 / 3) and row.max == 2.0
    assert statistics.statistics_of(statistics.partial_statistics(df.limit(0), ["a"])).count() == 0
    one = statistics.statistics_of(statistics.partial_statistics(df.limit(1), ["a"])).first()
    assert (one.mean, one.variance, one["count"]) == (1.0, 0.0, 1)
