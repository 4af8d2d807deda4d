"""Column statistics as rows that can be stored and merged.

A partial row holds, for one column, what its rows were: how many, their weight
and squared weight, the mean, the sum of squared gaps from it, extremes and
absolute sums. Partials of disjoint rows merge by the formulas for moments, so a
day's rows are added to a store without reading older ones, and a table of
partials gives the same statistics as all the rows at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTIAL = (
    "column string, rows bigint, nonzeros bigint, weight double, weight_squares double, mean double, gaps double,"
    " max double, min double, absolute double, squares double"
)


def partial_statistics(df: DataFrame, columns: Sequence[str], weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Partial rows of each column, per group of ``by`` if any, in one pass.

    Rows with weight 0 or less or a missing weight are left out, and so are rows
    in which a column is missing.
    """
    weights = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.na.drop(subset=list(columns)).filter(weights > 0)
    vector = array_to_vector(F.array(*[F.col(name).cast("double") for name in columns]))
    names = ("mean", "variance", "numNonZeros", "max", "min", "normL1", "normL2")
    summary = Summarizer.metrics(*names, "count").summary(vector, weights)
    # Grouped by a constant if by nothing else, so that no rows give no group.
    sums = rows.groupBy(*(by or [F.lit(0).alias("_all")])).agg(summary.alias("s"), F.sum(weights).alias("w"), F.sum(weights * weights).alias("ww"))
    at = lambda name, i: F.get(vector_to_array(F.col(f"s.{name}")), F.lit(i))
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("s.count").alias("rows"),
            at("numNonZeros", i).cast("bigint").alias("nonzeros"),
            F.col("w").alias("weight"),
            F.col("ww").alias("weight_squares"),
            at("mean", i).alias("mean"),
            (at("variance", i) * (F.col("w") - F.col("ww") / F.col("w"))).alias("gaps"),
            at("max", i).alias("max"),
            at("min", i).alias("min"),
            at("normL1", i).alias("absolute"),
            (at("normL2", i) * at("normL2", i)).alias("squares"),
        )
        for i, name in enumerate(columns)
    ]
    found = sums.select(*by, F.explode(F.array(*cells)).alias("p"))
    return found.select(*by, "p.*")


def merged_statistics(partials: DataFrame) -> DataFrame:
    """One partial row per column from any number of them.

    The mean comes first; gaps of means from it are then added to the gaps
    within the partials, so nothing is lost by subtracting large numbers. Each
    of both steps is combined before its shuffle.
    """
    first = partials.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nonzeros").alias("nonzeros"),
        F.sum("weight").alias("weight"),
        F.sum("weight_squares").alias("weight_squares"),
        (F.sum(F.col("weight") * F.col("mean")) / F.sum("weight")).alias("mean"),
        F.max("max").alias("max"),
        F.min("min").alias("min"),
        F.sum("absolute").alias("absolute"),
        F.sum("squares").alias("squares"),
    )
    # One row per column of the table.
    means = F.broadcast(first.select(F.col("column").alias("_column"), F.col("mean").alias("_mean")))
    met = partials.join(means, F.col("column") == F.col("_column"))
    gap = F.col("mean") - F.col("_mean")
    gaps = met.groupBy("_column").agg(F.sum(F.col("gaps") + F.col("weight") * gap * gap).alias("gaps"))
    return first.join(gaps, F.col("column") == F.col("_column")).select(*[part.split()[0] for part in PARTIAL.split(", ")])


def merged_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two tables with one partial row per column as one, by the pairwise formula."""
    both = a.alias("a").join(b.alias("b"), "column", "full")
    one = lambda name: F.coalesce(F.col(f"a.{name}"), F.lit(0))
    two = lambda name: F.coalesce(F.col(f"b.{name}"), F.lit(0))
    weight = one("weight") + two("weight")
    gap = two("mean") - one("mean")
    shared = {name: (one(name) + two(name)).alias(name) for name in ("rows", "nonzeros", "weight_squares", "absolute", "squares")}
    return both.select(
        "column",
        shared["rows"],
        shared["nonzeros"],
        weight.alias("weight"),
        shared["weight_squares"],
        (one("mean") + gap * two("weight") / weight).alias("mean"),
        (one("gaps") + two("gaps") + gap * gap * one("weight") * two("weight") / weight).alias("gaps"),
        F.greatest("a.max", "b.max").alias("max"),
        F.least("a.min", "b.min").alias("min"),
        shared["absolute"],
        shared["squares"],
    )


def statistics_of(partials: DataFrame, scale: int | None = None) -> DataFrame:
    """The statistics of a table of partial rows: mean, unbiased variance
    (reliability weights), count, non-zeros, extremes and norms per column."""
    shown = lambda value: value if scale is None else F.round(value, scale)
    spread: Column = F.try_divide(F.col("gaps"), F.col("weight") - F.col("weight_squares") / F.col("weight"))
    return merged_statistics(partials).select(
        "column",
        shown(F.col("mean")).alias("mean"),
        shown(F.coalesce(spread, F.lit(0.0))).alias("variance"),
        F.col("rows").alias("count"),
        F.col("nonzeros").alias("num_nonzeros"),
        "max",
        "min",
        shown(F.col("absolute")).alias("norm_l1"),
        shown(F.sqrt("squares")).alias("norm_l2"),
    )


def add_to_store(partials: DataFrame, store: str, part: str) -> None:
    """Store the partial rows of one part (a day, say); nothing stored is read,
    and a part that is added again replaces what it added before."""
    partials.select(*[name.split()[0] for name in PARTIAL.split(", ")]).write.mode("overwrite").parquet(f"{store}/part={part}")


def stored_statistics(spark: SparkSession, store: str, scale: int | None = None) -> DataFrame:
    """Statistics of all parts of a store."""
    return statistics_of(spark.read.schema(PARTIAL).parquet(store), scale)
