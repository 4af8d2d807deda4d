"""Choosing, naming and adding columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """All columns but the listed ones, in their order."""
    return df.drop(*columns)


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Columns renamed to ``prefix__name``, except those in ``keep``."""
    kept = set(keep)
    return df.withColumnsRenamed({name: f"{prefix}__{name}" for name in df.columns if name not in kept})


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Columns cast to the given types; unreadable values become null unless
    ``strict``."""
    return df.withColumns(
        {
            name: F.col(name).cast(kind) if strict else F.col(name).try_cast(kind)
            for name, kind in types.items()
        }
    )


def at_positions(df: DataFrame, names: Mapping[int, str]) -> DataFrame:
    """Columns chosen by position (from 0) and renamed."""
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(name) for i, name in names.items()])


def stacked_by_task(results: Mapping[str, DataFrame], column: str = "task") -> DataFrame:
    """Result tables of several tasks under each other, each row tagged."""
    tagged: Sequence[DataFrame] = [df.withColumn(column, F.lit(task)) for task, df in results.items()]
    return reduce(lambda top, bottom: top.unionByName(bottom), tagged)
