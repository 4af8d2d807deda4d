"""Key joins. Every join is an equi-join, so Spark may broadcast a side it
measures as small and splits skewed keys at run time otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

JOIN_TYPES = ("left", "right", "full")
STRATEGIES = ("broadcast", "shuffle_hash", "merge")
# Rows and bytes (as JSON text) up to which a side counts as small.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


def join_tables(tables: Sequence[DataFrame], key: str | Sequence[str], how: str = "left") -> DataFrame:
    """First table joined with each further one on ``key``.

    Meant for further tables that were grouped by the key: they have one row
    per key and stay where their grouping put them. Tables from elsewhere are
    joined with :func:`join_checked`, raw rows with :func:`enrich`.
    """
    if how not in JOIN_TYPES:
        raise ValueError(f"join type must be one of {JOIN_TYPES}, not {how!r}")
    return reduce(lambda done, table: done.join(table, _names(key), how), tables)


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def repeated_keys(tables: Mapping[str, DataFrame], key: str | Sequence[str]) -> DataFrame:
    """(table_name, key_text, key_count): the keys that a table has in more
    than one row.

    Only the key columns are read; counts combine before they move, so a key
    that holds much of a table costs no more than another. A key with a missing
    part meets nothing in a join and is never repeated.
    """
    if not tables:
        raise ValueError("no tables to look for repeated keys in")
    keys = _names(key)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

    def of(name: str, table: DataFrame) -> DataFrame:
        counts = table.filter(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        text = F.to_json(F.struct(*keys))
        return counts.select(F.lit(name).alias("table_name"), text.alias("key_text"), F.col("_n").alias("key_count"))

    return reduce(DataFrame.union, [of(name, table) for name, table in tables.items()])


def join_checked(tables: Mapping[str, DataFrame], key: str | Sequence[str], how: str = "left") -> DataFrame:
    """:func:`join_tables` after a look at the keys of all further tables.

    A key that repeats there would multiply rows, so it fails the call before
    anything is joined. The first table may repeat keys; its rows come from
    the source and not from a grouping, so one that holds much of the table is
    split at run time.
    """
    named = list(tables.items())
    if len(named) > 1:
        # The first one found will do: one row comes to the driver.
        found = repeated_keys(dict(named[1:]), key).first()
        if found is not None:
            raise ValueError(f"{found.table_name} has {found.key_count} rows with the key {found.key_text}")
    return join_tables([table for _, table in named], key, how)


def existing_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Those of the named tables that the catalog knows, in the given order."""
    return [name for name in names if spark.catalog.tableExists(name)]


def join_catalog(spark: SparkSession, names: Sequence[str], key: str, how: str = "left") -> DataFrame:
    """Fold join over the named tables; names without a table are skipped. A
    further table that repeats a key fails the join."""
    found = existing_tables(spark, names)
    if not found:
        raise ValueError(f"none of the tables exists: {list(names)}")
    return join_checked({name: spark.table(name) for name in found}, key, how)


def join_unique(rows: DataFrame, unique: DataFrame, key: str, how: str) -> DataFrame:
    """Rows of any skew joined with a table that has one row per key.

    A table grouped by the key is already placed by it, and a join that uses
    that placement cannot be split at run time. The null-safe comparison asks
    for a shuffle of its own, so that adaptive execution may cut a key that
    holds much of the rows into several tasks. Missing keys match nothing.
    """
    renamed = unique.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_key")
    return rows.join(renamed, F.col(key).eqNullSafe(F.col("_key")), how).drop("_key")


def enrich(facts: DataFrame, dimension: DataFrame, key: str, drop: Sequence[str] = ()) -> DataFrame:
    """Facts with the columns of a dimension that has one row per key."""
    return join_unique(facts, dimension.drop(*drop), key, "left")


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is within both limits, measured by reading it (no
    further than the row limit)."""
    text = F.length(F.to_json(F.struct(*df.columns)))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return found[0] <= rows and found[1] <= size


def with_strategy(
    left: DataFrame, right: DataFrame, key: str | Sequence[str], strategy: str, how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with a physical strategy asked for on the right side.

    The right side is measured before it is broadcast; above the limits the
    sides are shuffled and merged instead.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy == "broadcast" and not is_small(right, broadcast_rows, broadcast_bytes):
        strategy = "merge"
    return left.join(right.hint(strategy), key, how)


def repeated_rows(df: DataFrame, key: str, count_name: str = "key_count") -> DataFrame:
    """Rows whose key occurs more than once, with the number of occurrences.

    Counts are combined before the shuffle and joined back, so that a key which
    holds much of the table is split and not windowed in one task.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)
    return join_unique(df, counts, key, "inner")


def side_by_side(
    left: DataFrame, right: DataFrame, line: str, left_text: str, right_text: str, separator: str = "    "
) -> DataFrame:
    """Lines of two equally long files put next to each other.

    Both tables carry their line number. A line that only one side has fails
    the job.
    """
    a = left.select(line, F.col(left_text).alias("_left"), F.lit(True).alias("_in_left"))
    b = right.select(line, F.col(right_text).alias("_right"), F.lit(True).alias("_in_right"))
    both = a.join(b, line, "full")
    complete = F.col("_in_left").isNotNull() & F.col("_in_right").isNotNull()
    merged = F.concat(F.col("_left"), F.lit(separator), F.col("_right"))
    return both.select(
        line, F.when(complete, merged).otherwise(F.raise_error(F.lit("files differ in length"))).alias("merged")
    )


def pairs_of_lists(df: DataFrame, left: Column, right: Column, left_name: str, right_name: str) -> DataFrame:
    """Every pair from two lists held in the same row. No rows are joined."""
    return df.withColumn(left_name, F.explode(left)).withColumn(right_name, F.explode(right))
