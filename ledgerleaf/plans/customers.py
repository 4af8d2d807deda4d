"""Customer features from current and historical transactions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from ledgerleaf.operators.aggregates import Period, period_features
from ledgerleaf.operators.features import assembled_base
from ledgerleaf.operators.joins import enrich

# Prefix of the columns made from older transactions.
HISTORICAL = "historical"


@dataclass(frozen=True)
class FeatureSpec:
    """Columns of the transactions (after enrichment) and how they are used."""

    key: str
    mode_columns: Sequence[str]
    sum_columns: Sequence[str]
    historical_sum_columns: Sequence[str]
    scale: int | None = None


def feature_table(
    transactions: DataFrame, dimension: DataFrame, dimension_key: str, spec: FeatureSpec, recent: Column, drop: Sequence[str] = ()
) -> DataFrame:
    """Current features where ``recent`` holds and, with fewer sums and prefixed
    names, historical ones elsewhere (also where it is null).

    The transactions are read, enriched and grouped once for both.
    """
    facts = enrich(transactions, dimension, dimension_key, drop)
    return period_features(facts, spec.key, spec.mode_columns, _periods(spec, recent), spec.scale)


def _periods(spec: FeatureSpec, recent: Column) -> list[Period]:
    return [Period(recent, spec.sum_columns), Period(None, spec.historical_sum_columns, f"{HISTORICAL}__")]


def plain_feature_table(transactions: DataFrame, spec: FeatureSpec, recent: Column) -> DataFrame:
    """:func:`feature_table` of transactions that need no dimension."""
    return period_features(transactions, spec.key, spec.mode_columns, _periods(spec, recent), spec.scale)


def customer_tables(train: DataFrame, test: DataFrame, features: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Train and test customers with their features; the test target is 0."""
    return assembled_base(train, key, features), assembled_base(test, key, features, target=target)
