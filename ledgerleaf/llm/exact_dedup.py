r"""Exact deduplication by a content sort.

Texts are equal when they are identical after every run of ``[\x20\x09-\x0D]``
became one space. Rows are range-partitioned between sampled splitters, sorted
externally inside each part so that equal texts lie next to each other, and
every text is compared in full with its neighbour.

The sort key is (first characters, 64-bit hash, text, identifier). The part of
a row depends on the first characters, the hash and the identifier only, so a
splitter is small however long the texts are, and a text that fills a third of
the table is spread over many parts by its identifiers. What such a text has in
several parts is put together from the runs at the ends of the parts, at most a
few small rows for each part.

Defined cases: a null text counts as empty, and empty texts are copies of each
other. Null identifiers sort last. Of rows that repeat text and identifier one
stays. An empty table gives an empty result. Columns other than the two named
ones may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerleaf.llm.registry import query, table
from ledgerleaf.scratch import materialize

#: Characters of a text that a splitter holds.
HEAD_CHARS = 32


def normalized(text):
    r"""The text with each ``[\x20\x09-\x0D]+`` replaced by one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_sorted(docs: DataFrame, text: str, row_id: str, *, keep_rows: bool) -> DataFrame:
    """Rows (row, id, content, hash, digest) in content order.

    ``row`` holds the whole input row if ``keep_rows`` is set; nesting it keeps
    its column names apart from ours.
    """
    row = [F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")] if keep_rows else []
    keyed = docs.select(*row, docs[f"`{row_id}`"].alias("id"), normalized(docs[f"`{text}`"]).alias("content"))
    keyed = keyed.withColumn("hash", F.xxhash64("content")).withColumn("head", F.left("content", F.lit(HEAD_CHARS)))
    ident = F.col("id").asc_nulls_last()
    ranged = keyed.repartitionByRange("head", "hash", ident)
    ordered = ranged.sortWithinPartitions("head", "hash", "content", ident)
    return ordered.withColumn("digest", F.sha2("content", 256)).drop("head")


class _Runs:
    """Follows sorted rows and says where a new text begins."""

    def __init__(self) -> None:
        self.hash = self.content = None

    def starts(self, batch: pa.RecordBatch) -> Iterator[bool]:
        content = batch.column("content")
        for i, value in enumerate(batch.column("hash").to_pylist()):
            text = content[i].as_buffer()
            yield value != self.hash or not text.equals(self.content)
            self.hash, self.content = value, text
        if self.content is not None:
            # The last text outlives its batch, so it gets memory of its own.
            self.content = pa.py_buffer(self.content.to_pybytes())


def _decisions(schema: pa.Schema):
    """One row for each input row, given out when its run is over."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        runs, first_hash = _Runs(), None
        open_runs: list[tuple] = []  # (hash, digest, ids) of the runs under the latest hash
        out: list[tuple] = []

        def close(edge: bool) -> None:
            for value, digest, ids in open_runs:
                at_edge = edge or value == first_hash
                for k, ident in enumerate(ids):
                    out.append((ident, ids[0], len(ids), k == 0, digest, part, at_edge))
            open_runs.clear()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            out.clear()
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            hashes, digests, ids = (batch.column(c).to_pylist() for c in ("hash", "digest", "id"))
            for i, new in enumerate(runs.starts(batch)):
                if first_hash is None:
                    first_hash = hashes[i]
                if new:
                    if open_runs and open_runs[-1][0] != hashes[i]:
                        close(False)
                    open_runs.append((hashes[i], digests[i], []))
                open_runs[-1][2].append(ids[i])
            if len(out) > 20_000:
                yield flush()
        close(True)
        yield flush()

    return work


def _firsts(schema: pa.Schema):
    """The first row of each run, with all its columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        runs, first_hash, last = _Runs(), None, None
        held: list[pa.RecordBatch] = []  # first rows under the latest hash
        for batch in batches:
            hashes = batch.column("hash").to_pylist()
            chosen = [i for i, new in enumerate(runs.starts(batch)) if new]
            if not chosen:
                continue
            first_hash = hashes[0] if first_hash is None else first_hash
            edge = [hashes[i] == first_hash for i in chosen]
            rows = batch.take(pa.array(chosen))
            made = pa.record_batch(
                [rows.column("row"), rows.column("digest"), pa.array([part] * len(chosen), pa.int32()), pa.array(edge)],
                schema=schema,
            )
            now = hashes[chosen[-1]]
            same = len(chosen)
            while same and hashes[chosen[same - 1]] == now:
                same -= 1
            if same or now != last:
                yield from held
                held = []
            yield made.slice(0, same)
            held.append(made.slice(same))
            last = now
        for batch in held:
            yield pa.record_batch([*batch.columns[:3], pa.array([True] * len(batch))], schema=schema)

    return work


def copy_groups(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    kind = docs.schema[row_id].dataType
    made = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("run_first", kind),
            T.StructField("run_size", T.LongType()),
            T.StructField("opens", T.BooleanType()),
            T.StructField("digest", T.StringType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("at_edge", T.BooleanType()),
        ]
    )
    ordered = content_sorted(docs, text, row_id, keep_rows=False)
    staged = materialize(ordered.mapInArrow(_decisions(to_arrow_schema(made)), made), "content-runs")
    # Runs at the ends of parts, one row each: all that a text can share with another part.
    runs = staged.filter("at_edge and opens")
    groups = runs.groupBy(F.col("digest").alias("edge_digest")).agg(
        F.min(F.struct("part", "run_first")).alias("lead"), F.sum("run_size").alias("all_rows")
    )
    joined = staged.join(
        F.broadcast(groups), F.col("at_edge") & (F.col("digest") == F.col("edge_digest")), "left"
    )
    leads = ~F.col("at_edge") | (F.col("part") == F.col("lead.part"))
    return joined.select(
        F.col("id").alias(row_id),
        F.when(F.col("at_edge"), F.col("lead.run_first")).otherwise(F.col("run_first")).alias("keep_id"),
        F.coalesce("all_rows", "run_size").alias("group_size"),
        (F.col("opens") & leads).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    made = T.StructType(
        [
            T.StructField("row", docs.schema),
            T.StructField("digest", T.StringType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("at_edge", T.BooleanType()),
        ]
    )
    ordered = content_sorted(docs, text, row_id, keep_rows=True)
    staged = materialize(ordered.mapInArrow(_firsts(to_arrow_schema(made)), made), "content-firsts")
    leads = staged.filter("at_edge").groupBy(F.col("digest").alias("edge_digest")).agg(F.min("part").alias("lead"))
    joined = staged.join(
        F.broadcast(leads), F.col("at_edge") & (F.col("digest") == F.col("edge_digest")), "left"
    )
    return joined.filter("not at_edge or part = lead").select("row.*")




SQL = r"""
with normal as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as content from documents
)
select doc_id,
       min(doc_id) over (partition by content) as keep_id,
       count(*) over (partition by content) as group_size,
       row_number() over (partition by content order by doc_id) = 1 as kept,
       sha256(content) as text_sha256
from normal
"""


@query("op3_exact_dedup", SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_groups(table(spark, sf_dir, "documents"))
