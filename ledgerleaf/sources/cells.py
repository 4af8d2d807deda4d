"""Cell tables: (rowkey, family, qualifier, value, version)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(value: str = "value", version: str = "version") -> Column:
    """Aggregate: the value of the highest version (of the greatest value
    among equal versions)."""
    return F.max(F.struct(version, value))[value]


def scan_cells(cells: DataFrame, families: Sequence[str], qualifier: str = "") -> DataFrame:
    """One row per row key with the newest cell of each family as a column.

    Extremes are combined before the shuffle, one per row key and task.
    """
    wanted = F.col("qualifier") == qualifier
    columns = [
        F.max(F.when(wanted & (F.col("family") == name), F.struct("version", "value")))["value"].alias(name)
        for name in families
    ]
    return cells.groupBy("rowkey").agg(*columns)
