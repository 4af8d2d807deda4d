"""Per-batch jobs. A batch's result is stored under its number, so a batch
that runs again after a failure replaces its own output."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerleaf.operators.sets import subtract
from ledgerleaf.scratch import fresh_path, materialize

BatchJob = Callable[[DataFrame], DataFrame]


def start_batches(
    stream: DataFrame,
    job: BatchJob,
    output: str,
    checkpoint: str,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``job`` on each micro-batch and store its rows as
    ``output/batch_id=N``. ``every`` is the batch interval; without it all
    available data is taken and the query ends."""

    def store(batch: DataFrame, number: int) -> None:
        job(batch).write.mode("overwrite").parquet(f"{output}/batch_id={number}")

    writer = stream.writeStream.foreachBatch(store).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stored_batches(spark: SparkSession, output: str, schema: str) -> DataFrame:
    """Rows of all finished batches with their ``batch_id``; none if no batch
    had data."""
    try:
        return spark.read.schema(f"{schema}, batch_id bigint").parquet(output)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, batch_id bigint")


def run_batches(stream: DataFrame, job: BatchJob, schema: str, mode: str = "append") -> DataFrame:
    """Process all available data batch by batch; returns the stored rows."""
    spark = stream.sparkSession
    output, checkpoint = fresh_path(spark, "batches"), fresh_path(spark, "progress")
    start_batches(stream, job, output, checkpoint, mode=mode).awaitTermination()
    return stored_batches(spark, output, schema)


def run_until(query: StreamingQuery, rows: int, seconds: float = 600) -> None:
    """Wait until a running query has taken ``rows`` rows in all, as told by its
    progress; fails with the query, or if it takes longer than ``seconds``."""
    seen: dict[int, int] = {}
    ends = time.monotonic() + seconds
    while sum(seen.values()) < rows:
        if query.exception() is not None:
            raise query.exception()
        if time.monotonic() > ends:
            raise TimeoutError(f"{sum(seen.values())} of {rows} rows after {seconds} seconds")
        for progress in query.recentProgress:
            seen[progress["batchId"]] = max(seen.get(progress["batchId"], 0), progress["numInputRows"])
        time.sleep(0.05)


def source_ranges(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, source, topic, partition, from_offset, until_offset) of every
    batch of a query, by the offsets that the query itself stored in its
    checkpoint before it ran the batch.

    Sources are numbered from 0. Record sources have a range per topic and
    partition; other sources one, without a topic. The first range of a
    partition begins at null: the query began where its options say. Ranges of
    consecutive batches touch, whatever rows the batches hold.
    """
    log = spark.read.text(f"{checkpoint}/offsets", wholetext=True)
    lines = F.split("value", "\n")
    # A version, the batch's metadata, then one line for each source.
    each = log.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).try_cast("bigint").alias("batch_id"),
        F.posexplode(F.slice(lines, 3, F.size(lines))).alias("source", "offsets"),
    ).filter(F.col("batch_id").isNotNull() & (F.col("offsets") != "-") & (F.col("offsets") != ""))
    topics = F.from_json("offsets", "map<string,map<string,bigint>>")
    plain = F.coalesce(F.get_json_object("offsets", "$.logOffset"), F.when(F.col("offsets").rlike(r"^\d+$"), F.col("offsets")))
    records = each.filter(plain.isNull()).select("batch_id", "source", F.explode(topics).alias("topic", "parts"))
    records = records.select("batch_id", "source", "topic", F.explode("parts").alias("partition", "until_offset"))
    single = each.filter(plain.isNotNull()).select(
        "batch_id", "source", F.lit(None).cast("string").alias("topic"), F.lit(None).cast("string").alias("partition"), plain.cast("bigint").alias("until_offset")
    )
    # One row per batch, source and partition.
    order = Window.partitionBy("source", "topic", "partition").orderBy("batch_id")
    return records.union(single).select(
        "batch_id",
        "source",
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.lag("until_offset").over(order).alias("from_offset"),
        "until_offset",
    )


def offset_ranges(batch: DataFrame) -> DataFrame:
    """First and one-past-last offset per topic and partition."""
    return batch.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def batch_subtract(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Per batch: left rows whose value is not on the right in that batch.

    Both streams run as one query, so a batch takes the new rows of both.
    """
    kind = dict(left.dtypes)[column]
    return run_batches(tagged_sides(left, right, column), subtract_sides(column), f"{column} {kind}")


def tagged_sides(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Both streams as one, its rows marked as ``kept`` (left) or not."""
    return left.select(F.lit(True).alias("kept"), column).union(right.select(F.lit(False).alias("kept"), column))


def subtract_sides(column: str) -> BatchJob:
    """The job that takes the right rows of a batch from its left ones."""

    def job(batch: DataFrame) -> DataFrame:
        # Stored once, so that the sources are not read for either side anew.
        stored = materialize(batch, "batch")
        return subtract(stored.filter("kept").select(column), stored.filter(~F.col("kept")).select(column))

    return job
