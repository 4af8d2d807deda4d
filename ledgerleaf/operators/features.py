"""Vectors, libsvm lines and customer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.arrays import as_doubles
from ledgerleaf.functions.numbers import is_finite, plain_number
from ledgerleaf.operators.aggregates import modes_and_sums
from ledgerleaf.operators.joins import join_tables


def assembled(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Number or numeric-text columns as one vector; a missing value fails."""
    values = [
        F.coalesce(F.col(name).try_cast("double"), F.raise_error(F.lit(f"no number in column {name}")).cast("double"))
        for name in columns
    ]
    return df.withColumn(output, array_to_vector(F.array(*values)))


def labeled_points(df: DataFrame) -> DataFrame:
    """First column as label, all others as the feature vector."""
    first, *rest = [F.col(f"`{name}`") for name in df.columns]
    return df.select(first.try_cast("double").alias("label"), array_to_vector(as_doubles(*rest)).alias("features"))


def libsvm_line(label: Column, features: Sequence[Column]) -> Column:
    """``label i:v ...`` with 1-based positions; missing, zero and non-finite
    values are left out."""
    cells = [
        F.when(is_finite(value) & (value != 0), F.concat(F.lit(f"{i}:"), plain_number(value)))
        for i, value in enumerate(features, start=1)
    ]
    return F.concat_ws(" ", label.cast("string"), *cells)


def libsvm_table(encoded: DataFrame, key: str, label: str) -> DataFrame:
    """(key, line) for a table of numbers; every other column is a feature."""
    features = [F.col(f"`{name}`") for name in encoded.columns if name not in (key, label)]
    return encoded.select(key, libsvm_line(F.col(label), features).alias("line"))


def customer_features(
    transactions: DataFrame, key: str, mode_columns: Sequence[str], sum_columns: Sequence[str], scale: int | None = None
) -> DataFrame:
    """One row per customer: most frequent values, then sums and averages.

    The transactions (and any join that enriches them) are read once.
    """
    return modes_and_sums(transactions, key, mode_columns, sum_columns, scale)


def assembled_base(base: DataFrame, key: str, *feature_tables: DataFrame, target: str | None = None) -> DataFrame:
    """Base customers left-joined with their feature tables.

    ``target`` adds a zero target, as prediction data has none.
    """
    if target is not None:
        base = base.withColumn(target, F.lit(0))
    return join_tables([base, *feature_tables], key)
