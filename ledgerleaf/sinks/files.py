"""Text, libsvm, point and score files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.scratch import materialize


def write_text(df: DataFrame, path: str, column: str = "value", one_file: bool = False) -> None:
    """One line per row. ``one_file`` moves all rows to one task: only for
    results known to be small."""
    lines = df.select(F.col(column).alias("value"))
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").text(path)


def write_points(points: DataFrame, path: str, x: str, y: str) -> None:
    """``x,y`` lines."""
    points.select(x, y).write.mode("overwrite").option("header", False).csv(path)


def write_scores(scores: DataFrame, path: str, columns: Sequence[str], sep: str = ",") -> None:
    scores.select(*columns).write.mode("overwrite").option("sep", sep).csv(path)


def write_libsvm(lines: DataFrame, path: str, key: str, names: Sequence[str]) -> DataFrame:
    """``.libsvm`` lines, ``.index`` keys in the same row order and ``.name``
    columns; returns the stored (key, line) table.

    Keys and lines are stored together first and both files are made from that
    table, so part *n* of one belongs to part *n* of the other.
    """
    stored = materialize(lines.select(key, "line"), "libsvm")
    write_text(stored, f"{path}.libsvm", "line")
    write_text(stored.select(F.col(key).cast("string").alias(key)), f"{path}.index", key)
    listed = lines.sparkSession.createDataFrame([(name,) for name in names], "value string")
    write_text(listed, f"{path}.name", one_file=True)
    return stored
