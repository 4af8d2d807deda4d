"""Matrices as tables of row vectors: (id, array<double>).

Missing numbers count as 0 and short vectors as if filled up with zeros; a null
vector is all zeros. Identifiers of rows and columns are unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers of a right-hand matrix that every task may hold (4 MB).
HELD_CELLS = 500_000
# Sides of a block of a right-hand matrix beyond that.
INNER, COLUMNS = 512, 1024
# Cells of a product that leave a task at once.
SENT_CELLS = 1 << 18


def padded(lists: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of ``width`` columns."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cells = lists.flatten().cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return cells.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(cells)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = cells[inside]
    return out


def _cells(rows: pa.Array, left: np.ndarray, columns: pa.Array, right: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The product of left rows and right columns, cell by cell."""
    step = max(1, SENT_CELLS // max(1, len(columns)))
    for first in range(0, len(left), step):
        value = left[first : first + step] @ right.T
        n = len(value)
        at = pa.array(np.repeat(np.arange(first, first + n), len(columns)))
        across = pa.array(np.tile(np.arange(len(columns)), n))
        yield pa.RecordBatch.from_arrays([rows.take(at), columns.take(across), pa.array(value.ravel())], names)


def multiply(
    left: DataFrame,
    right_columns: DataFrame,
    *,
    row: str,
    column: str,
    vector: str,
    held_cells: int = HELD_CELLS,
    inner: int = INNER,
    columns: int = COLUMNS,
) -> DataFrame:
    """Product of two matrices, as (row, column, value).

    ``left`` has one row per matrix row and ``right_columns`` one row per column
    of the right matrix, whose size is measured first. Up to ``held_cells``
    numbers it is broadcast and the rows of ``left`` stay where they are. Beyond
    that both are cut into blocks (see :func:`block_products`). ``left`` is read
    once either way.
    """
    sizes = right_columns.agg(F.count(F.lit(1)), F.sum(F.size(vector)), F.max(F.size(vector))).first()
    n_columns, cells, width = sizes[0], sizes[1] or 0, max(sizes[2] or 0, 0)
    if cells > held_cells:
        return block_products(left, right_columns, row=row, column=column, vector=vector, width=width, n_columns=n_columns, inner=inner, columns=columns)
    known = right_columns.select(column, vector).toArrow()
    ids, kept = known.column(0).combine_chunks(), padded(known.column(1), width)
    sent = left.sparkSession.sparkContext.broadcast((ids, kept))
    schema = T.StructType([left.schema[row], right_columns.schema[column], T.StructField("value", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = sent.value
        for batch in batches:
            yield from _cells(batch.column(0), padded(batch.column(1), width), names, matrix, schema.names)

    return left.select(row, vector).mapInArrow(work, schema)


def _pieces(vector: Column, inner: int, count: int) -> Column:
    """One row for each run of ``inner`` numbers of a vector."""
    whole = F.coalesce(vector, F.array().cast("array<double>")).cast("array<double>")
    return F.explode(
        F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.struct(k.alias("k"), F.slice(whole, k * inner + 1, F.lit(inner)).alias("piece")))
    )


def block_products(
    left: DataFrame, right_columns: DataFrame, *, row: str, column: str, vector: str, width: int, n_columns: int, inner: int, columns: int
) -> DataFrame:
    """Two-dimensional block product for a right matrix of any size.

    The shared dimension is cut into runs k of ``inner`` numbers, the columns
    into sets j of about ``columns``, the rows into sets g. A block (k, j) of
    the right matrix is sent to every g and a run k of a left row to every j;
    both meet under the key (g, k, j). A task gets a key's right columns first
    and then multiplies the left rows as they stream by, so it holds one right
    block and one batch of rows. Partial products are summed by (row, column).
    """
    runs, sets = max(1, ceil(width / inner)), max(1, ceil(n_columns / columns))
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, ceil(tasks / (runs * sets)))
    of = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["g", "k", "j"]
    nothing = lambda df, name: F.lit(None).cast(df.schema[name].dataType)
    a = left.select(F.col(row).alias("r"), of(row, groups).alias("g"), _pieces(F.col(vector), inner, runs).alias("p"))
    a = a.select("g", F.col("p.k").alias("k"), spread(sets).alias("j"), F.lit(1).alias("side"), "r", nothing(right_columns, column).alias("c"), "p.piece")
    b = right_columns.select(F.col(column).alias("c"), of(column, sets).alias("j"), _pieces(F.col(vector), inner, runs).alias("p"))
    b = b.select(spread(groups).alias("g"), F.col("p.k").alias("k"), "j", F.lit(0).alias("side"), nothing(left, row).alias("r"), "c", "p.piece")
    dealt = a.unionByName(b).repartition(*key).sortWithinPartitions(*key, "side")
    schema = T.StructType(
        [T.StructField(row, left.schema[row].dataType), T.StructField(column, right_columns.schema[column].dataType), T.StructField("value", T.DoubleType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, names, matrix, held = None, [], [], None
        for batch in batches:
            tags = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = np.flatnonzero((tags[1:] != tags[:-1]).any(axis=1)) + 1
            for first, last in zip([0, *cuts], [*cuts, len(tags)], strict=True):
                part, place = batch.slice(first, last - first), tuple(tags[first][:3])
                if place != block:
                    block, names, matrix, held = place, [], [], None
                numbers = padded(part.column(6), inner)
                if tags[first][3] == 0:
                    names.append(part.column(5))
                    matrix.append(numbers)
                elif matrix:
                    held = held or (pa.concat_arrays(names), np.concatenate(matrix))
                    yield from _cells(part.column(4), numbers, *held, schema.names)

    partial = dealt.mapInArrow(work, schema)
    if runs == 1:
        return partial
    return partial.groupBy(row, column).agg(F.sum("value").alias("value"))


def gram(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Sums of products of every two columns, as one row (i, array<double>) per
    column. Each task sums its rows first; only width x width sums move."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            rows = padded(batch.column(0), width)
            total += rows.T @ rows
        i, j = np.divmod(np.arange(width * width), max(width, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "x"])

    sums = df.select(vector).mapInArrow(work, "i bigint, j bigint, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    # One list per column, as long as the matrix is wide.
    row = F.transform(F.sort_array(F.collect_list(F.struct("j", "x"))), lambda cell: cell["x"])
    return sums.groupBy("i").agg(row.alias(vector))


def column_of(df: DataFrame, row: str, vector: str, position: int, factor: float = 1.0) -> DataFrame:
    """One column of the matrix (from 0), times a number."""
    return df.select(row, (F.col(vector)[position] * F.lit(factor)).alias("value"))
