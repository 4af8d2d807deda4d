"""Catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.scratch import fresh_path
from ledgerleaf.sources.delimited import path_exists


def _writer(df: DataFrame, path: str | None):
    return df.write.option("path", path) if path else df.write


def _swap(spark: SparkSession, beside: str, name: str) -> DataFrame:
    """The finished table takes the name; the table that had it goes last."""
    old = f"{name}_old_{uuid.uuid4().hex}"
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    if had:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def _beside(name: str) -> str:
    return f"{name}_new_{uuid.uuid4().hex}"


def replace_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a table, replacing one of that name; returns the stored table.

    The new table is complete before the old one goes, so the rows may come
    from the table that is replaced, and a failed job leaves it as it was. A
    given path must be one that the old table does not use.
    """
    beside = _beside(name)
    _writer(df, path).mode("errorifexists").saveAsTable(beside)
    return _swap(df.sparkSession, beside, name)


def replace_parts(df: DataFrame, column: str, names: Mapping[str, str], path: str | None = None) -> dict[str, DataFrame]:
    """One table for each value of a column, all written in one pass.

    ``names`` maps the values to table names. The tables are external, each
    over the folder of its value; a value without rows gets an empty table.
    """
    spark = df.sparkSession
    folder = path or fresh_path(spark, "parts")
    df.filter(F.col(column).isin(*names)).write.partitionBy(column).parquet(folder)
    rows = df.drop(column)
    stored = {}
    for value, name in names.items():
        part = f"{folder}/{column}={value}"
        if not path_exists(spark, part):
            rows.limit(0).write.parquet(part)
        beside = _beside(name)
        spark.catalog.createTable(beside, path=part, source="parquet", schema=rows.schema)
        stored[name] = _swap(spark, beside, name)
    return stored


def create_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write a new table; fails if the name is taken."""
    _writer(df, path).mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def _spread_by_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows brought together by bucket, large buckets split over several tasks.

    The rows of each bucket are counted first; a bucket above twice the mean
    size is cut into pieces of about the mean size. The pieces are files of
    the same bucket.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    sizes = {row[0]: row[1] for row in df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1))).collect()}
    mean = max(1, sum(sizes.values()) // buckets)
    pieces = {b: -(-n // mean) for b, n in sizes.items() if n > 2 * mean}
    if not pieces:
        return df.repartition(buckets, bucket)
    row = F.xxhash64(*df.columns) + F.spark_partition_id()
    count = F.create_map(*[F.lit(item) for pair in pieces.items() for item in pair])
    piece = F.pmod(row, F.coalesce(F.try_element_at(count, bucket), F.lit(1)))
    return df.repartition(buckets + sum(pieces.values()), bucket, piece)


def replace_keyed_table(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """As :func:`replace_table`, stored in buckets of the key.

    Later joins and aggregates on the key read the buckets without a shuffle.
    """
    beside = _beside(name)
    clustered = _spread_by_bucket(df, key, buckets)
    _writer(clustered, path).mode("errorifexists").bucketBy(buckets, key).sortBy(key).saveAsTable(beside)
    return _swap(df.sparkSession, beside, name)
