"""Counts over sliding windows of event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.streaming.jobs import run_batches

#: Pieces over which the rows of one window and value are dealt.
PIECES = 16


def sliding_counts(
    stream: DataFrame, at: str, length: str, slide: str, offset: str | None = None, lateness: str | None = None
) -> DataFrame:
    """Rows per sliding window, as a streaming aggregate (start, end, n).

    With ``lateness`` a window's state goes once the latest time seen is so far
    past its end, and rows that come later are left out. Without it every
    window is kept for good.
    """
    if lateness:
        stream = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    moment = F.col(at).cast("timestamp") if not lateness else F.col(at)
    window = F.window(moment, length, slide, offset) if offset else F.window(moment, length, slide)
    return stream.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"
    )


def run_sliding_counts(
    stream: DataFrame, at: str, length: str, slide: str, offset: str | None = None, lateness: str | None = None
) -> DataFrame:
    """Window counts after all available data.

    Each batch stores only the windows it changed (update mode); the count of
    a window only grows, so its last value is its greatest.
    """
    counts = sliding_counts(stream, at, length, slide, offset, lateness)
    changed = run_batches(counts, lambda batch: batch, "start timestamp, end timestamp, n bigint", mode="update")
    return changed.groupBy("start", "end").agg(F.max("n").alias("n"))


def windowed_subtract(
    left: DataFrame,
    right: DataFrame,
    at: str,
    column: str,
    length: str,
    lateness: str,
    spread: Sequence[str] = (),
    pieces: int = PIECES,
) -> DataFrame:
    """Left rows whose value the right stream does not have in the same window
    of event time, as a stream (start, end, value).

    A row comes out once the watermarks of both streams have passed its
    window; how the streams are cut into batches does not matter. Missing
    values are equal to nothing and come out, as repeated left rows do; rows
    without a time belong to no window and are left out.

    A value that holds much of a window is dealt over ``pieces``: left rows by a
    hash of their time and of the ``spread`` columns (those that tell rows of
    one moment apart), the one right row of a window and value to each piece.
    """

    def windowed(stream: DataFrame, window: str, value: str) -> DataFrame:
        timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
        piece = F.pmod(F.xxhash64(at, *[c for c in spread if c in stream.columns]), F.lit(pieces))
        return timed.select(F.window(at, length).alias(window), F.col(column).alias(value), piece.alias(f"{window}_piece"))

    a = windowed(left, "w", column)
    # Twice, so that one task sees at most a row per piece of a hot value.
    b = windowed(right, "r", "_right").dropDuplicates(["r", "_right", "r_piece"]).dropDuplicates(["r", "_right"])
    every = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)).cast("array<bigint>"))
    b = b.select("r", "_right", every.alias("r_piece"))
    same = (F.col("w") == F.col("r")) & (F.col(column) == F.col("_right")) & (F.col("w_piece") == F.col("r_piece"))
    joined = a.join(b, same, "left_outer")
    return joined.filter(F.col("r").isNull()).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), column
    )
