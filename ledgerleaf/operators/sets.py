"""Rows of two tables as sets and bags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found in both; repeats go before the shuffle."""
    return left.distinct().intersect(right.distinct())


def subtract(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Left rows whose value is absent on the right; repeated rows stay
    repeated."""
    names = list(columns or left.columns)
    gone = right.select(*[F.col(name).alias(f"_r_{name}") for name in names]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in names])
    return left.join(gone, same, "left_anti")


def first_distinct(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` lowest distinct values, missing ones left out."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)
