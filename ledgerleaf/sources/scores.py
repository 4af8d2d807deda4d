"""Generated scores: two clamped normal populations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.functions.numbers import clamp, hashed_gaussian, hashed_uniform

# Mean and variance of negatives and positives per population.
POPULATIONS = {
    "good": ((0.3, 0.1), (0.8, 0.1)),
    "mid": ((0.3, 0.5), (0.8, 0.5)),
    "bad": ((0.4, 1.0), (0.7, 1.0)),
    "simulated": ((0.15, 0.1), (0.7, 0.3)),
}
NEGATIVES = 100_000
POSITIVES = 2_000


def draw_scores(
    rows: DataFrame, key: str, positive: Column, negatives: tuple[float, float], positives: tuple[float, float], salt: str = "score"
) -> DataFrame:
    """(key, score, label) with one draw per given row, fixed by its key."""
    label = F.when(positive, 1.0).otherwise(0.0)
    mean = F.when(positive, positives[0]).otherwise(negatives[0])
    variance = F.when(positive, positives[1]).otherwise(negatives[1])
    return rows.select(
        key, clamp(hashed_gaussian(F.col(key), salt, mean, variance)).alias("score"), label.alias("label")
    )


def generate_scores(
    spark: SparkSession, population: str, negatives: int = NEGATIVES, positives: int = POSITIVES, seed: int = 0
) -> DataFrame:
    """A generated score table: negatives first, then positives."""
    low, high = POPULATIONS[population]
    ids = spark.range(negatives + positives)
    return draw_scores(ids, "id", F.col("id") >= negatives, low, high, salt=f"{population}/{seed}")


def generate_regression_pairs(
    spark: SparkSession, rows: int, first: tuple[float, float], second: tuple[float, float], seed: int = 0
) -> DataFrame:
    """Pairs of independent clamped normal draws."""
    key = F.col("id")
    return spark.range(rows).select(
        "id",
        clamp(hashed_gaussian(key, f"x/{seed}", *first)).alias("score"),
        clamp(hashed_gaussian(key, f"y/{seed}", *second)).alias("label"),
    )


def uniform_labels(rows: DataFrame, key: str, output: str = "label", salt: str = "label") -> DataFrame:
    """(key, uniform label), one per given row and fixed by its key."""
    return rows.select(key, hashed_uniform(F.col(key), salt).alias(output))


def generate_uniform_scores(spark: SparkSession, rows: int, seed: int = 0) -> DataFrame:
    """(index, uniform score, label 0 or 1), independent of each other."""
    key = F.col("id")
    label = (hashed_uniform(key, f"label/{seed}") * 2).cast("int")
    return spark.range(rows).select(
        key.alias("index"), hashed_uniform(key, f"score/{seed}").alias("score"), label.alias("label")
    )


def generate_matrix(spark: SparkSession, rows: int, width: int, high: float = 10.0, seed: int = 0) -> DataFrame:
    """Uniform numbers in (0, high), one column per matrix column."""
    key = F.col("id")
    return spark.range(rows).select(
        *[(hashed_uniform(key, f"{i}/{seed}") * high).alias(f"c{i}") for i in range(width)]
    )
