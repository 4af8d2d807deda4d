"""Cell upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.sources.cells import newest

CELL = "rowkey string, family string, qualifier string, value string, version bigint"
CELL_COLUMNS = [part.split()[0] for part in CELL.split(", ")]


def as_cells(df: DataFrame, rowkey: str, value: str, family: str, qualifier: str, version: Column) -> DataFrame:
    """(rowkey, value) pairs as cells of one family and qualifier."""
    return df.select(
        F.col(rowkey).cast("string").alias("rowkey"),
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        F.col(value).cast("string").alias("value"),
        version.alias("version"),
    )


def resolve_cells(cells: DataFrame) -> DataFrame:
    """The newest version of each cell."""
    merged = cells.groupBy("rowkey", "family", "qualifier")
    return merged.agg(newest().alias("value"), F.max("version").alias("version"))


def put_cells(puts: DataFrame, store: str, batch: str) -> None:
    """Add the versions of one batch to a store; nothing stored is read.

    A batch that is put again replaces what it put before.
    """
    puts.write.mode("overwrite").parquet(f"{store}/batch={batch}")


def cell_writer(store: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: each micro-batch is put under its number."""
    return lambda batch, number: put_cells(batch, store, str(number))


def read_cells(spark: SparkSession, store: str) -> DataFrame:
    """The newest cells of a store; versions are resolved here."""
    return resolve_cells(spark.read.parquet(store).drop("batch"))


def compact_cells(spark: SparkSession, store: str, into: str) -> None:
    """The store's newest cells as a store of their own."""
    put_cells(read_cells(spark, store), into, "compacted")


def upsert_cells(stored: DataFrame, puts: DataFrame) -> DataFrame:
    """Stored cells and new ones merged: the newest version of each cell."""
    return resolve_cells(stored.unionByName(puts))


#: Batches of a level that are merged into one of the next.
BATCHES_PER_LEVEL = 4


class LevelStore:
    """A cell store of levels, as one table bucketed by row key.

    A batch is a partition of level 0, written once and never changed. When a
    level has ``BATCHES_PER_LEVEL`` of them, their newest cells become one batch
    of the next level: compaction reads only its own level, and a cell is
    written again once per level. All batches deal row keys to the same buckets,
    so that reading and merging need no shuffle. Versions decide, not batches:
    a merged batch beside the batches it came from changes no result, so a
    compaction that stops half way does no harm.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int, per_level: int = BATCHES_PER_LEVEL) -> None:
        self.spark, self.name, self.buckets, self.per_level = spark, name, buckets, per_level
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], f"{CELL}, level int, batch string")
            empty.write.partitionBy("level", "batch").bucketBy(buckets, "rowkey").sortBy("rowkey").saveAsTable(name)

    def _write(self, cells: DataFrame, level: int, batch: str, how: str) -> None:
        into = f"INSERT {how} TABLE {self.name} PARTITION (level = {level}, batch = '{batch}')"
        cells.sparkSession.sql(f"{into} SELECT {', '.join(CELL_COLUMNS)} FROM {{cells}}", cells=cells)

    def put(self, puts: DataFrame, batch: str) -> None:
        """Add a batch; one that is put again replaces what it put before, or
        joins what was merged since. Nothing stored is read."""
        # Dealt once here, so that a bucket is one file.
        self._write(puts.repartition(self.buckets, "rowkey"), 0, batch, "OVERWRITE")

    def batches(self) -> dict[int, list[str]]:
        """The batches of each level, by the table's partitions."""
        found: dict[int, list[str]] = {}
        for (said,) in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            level, batch = (part.split("=", 1)[1] for part in said.split("/"))
            found.setdefault(int(level), []).append(batch)
        return {level: sorted(names) for level, names in found.items()}

    def compact(self) -> int:
        """Merge every level that is full, from the lowest; returns how many were."""
        merged, level = 0, 0
        while level <= max(self.batches(), default=-1):
            names = self.batches().get(level, [])
            if len(names) >= self.per_level:
                mine = self.spark.table(self.name).filter(F.col("level") == level)
                self._write(resolve_cells(mine), level + 1, f"{names[0]}-{names[-1]}", "INTO")
                for batch in names:
                    self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION (level={level}, batch='{batch}')")
                merged += 1
            level += 1
        return merged

    def writer(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: each micro-batch is put under its number, and
        full levels are merged."""

        def write(batch: DataFrame, number: int) -> None:
            self.put(batch, f"{number:012d}")
            self.compact()

        return write

    def read(self) -> DataFrame:
        """The newest cells; every bucket is resolved where it lies."""
        return resolve_cells(self.spark.table(self.name))
