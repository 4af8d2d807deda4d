"""Maps a function over the texts of a table, partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm import words as W


def text_groups(column: pa.Array, size: int = W.BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``size`` bytes together, with the place of their
    first; null counts as empty."""
    column = W.text_array(column)
    _, offsets = W.buffers(column)
    raw = column.cast(pa.large_binary())
    for first, last in W.blocks(offsets, size):
        yield first, raw.slice(first, last - first).to_pylist()


def map_texts(
    docs: DataFrame,
    text: str,
    carried: list[str],
    made: list[T.StructField],
    report: Callable[[list[bytes]], list[pa.Array]],
) -> DataFrame:
    """Rows (row, and the columns that ``report`` makes of each group of texts).

    ``row`` holds the carried columns; nesting keeps their names apart from the
    made ones. Memory is bounded by a batch, not by a partition.
    """
    row = F.struct(*[docs[f"`{name}`"] for name in carried]).alias("row")
    kept = T.StructType([docs.schema[name] for name in carried])
    schema = T.StructType([T.StructField("row", kept), *made])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in text_groups(batch.column(1)):
                rows = batch.column(0).slice(first, len(group))
                yield pa.RecordBatch.from_arrays([rows, *report(group)], schema.names)

    return docs.select(row, docs[f"`{text}`"].alias("content")).mapInArrow(work, schema)
