"""Streams of files and of Kafka records."""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Start at the oldest record, keep the group's offsets uncommitted.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream. ``path`` is a folder or a single file."""
    stored = spark.read.parquet(path)
    reader = spark.readStream.schema(stored.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    found = stored.select("_metadata.file_path").first()
    folder, name = posixpath.split(path.rstrip("/"))
    if found is not None and posixpath.basename(found[0]) == name:
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def kafka_options(brokers: Sequence[str], topics: Sequence[str], group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": ",".join(brokers), "subscribe": ",".join(topics), **KAFKA_DEFAULTS}
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_stream(
    spark: SparkSession, brokers: Sequence[str], topics: Sequence[str], group: str | None = None
) -> DataFrame:
    """Kafka records as text. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topics, group))
    return reader.load().select(
        "topic", "partition", "offset", F.col("key").cast("string"), F.col("value").cast("string")
    )


def as_records(
    df: DataFrame, topic: Column, partition: Column, offset: Column, key: Column, value: Column
) -> DataFrame:
    """Any stream in the shape of Kafka records."""
    return df.select(
        topic.cast("string").alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
    )
