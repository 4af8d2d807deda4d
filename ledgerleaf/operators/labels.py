"""Label columns and data splits."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.numbers import hash_bucket
from ledgerleaf.operators.clean import fill_for_labels


@dataclass(frozen=True)
class LabelTask:
    """A weighted label: the columns it is made of and their weights."""

    columns: tuple[str, ...]
    weights: tuple[float, ...]

    def __post_init__(self):
        if len(self.columns) != len(self.weights):
            raise ValueError("a label needs as many weights as columns")


# Weights of the three standing tasks.
TASK_WEIGHTS = {"m1": (0.5, 0.5), "m2": (0.3, 0.3, 0.3, 0.1), "m3": (0.5, 0.5)}
# Shares of train, valid and test rows in the standing splits.
TRAIN_VALID_TEST = (0.7, 0.2, 0.1)
TRAIN_TEST = (0.6, 0.4)


def standing_tasks(m1: Sequence[str], m2: Sequence[str], m3: Sequence[str]) -> dict[str, LabelTask]:
    """The three tasks with their standing weights over the given columns."""
    columns = {"m1": m1, "m2": m2, "m3": m3}
    return {name: LabelTask(tuple(columns[name]), weights) for name, weights in TASK_WEIGHTS.items()}


def _scaled(value: Column, low: Column, high: Column) -> Column:
    return F.when(high == low, F.lit(0.5)).otherwise((value - low) / (high - low))


def weighted_labels(df: DataFrame, key: str, tasks: Mapping[str, LabelTask]) -> DataFrame:
    """(key, one label per task): each column scaled to [0, 1], then summed by
    weight.

    Missing and unreadable values count as 0. A constant column scales to 0.5.
    The extremes of all columns are one aggregate, read through a scalar
    subquery, so the table is scanned twice for any number of tasks.
    """
    names = list(dict.fromkeys(name for task in tasks.values() for name in task.columns))
    # Inside a struct the key is not filled: a missing one stays missing.
    apart = F.struct(F.col(key).alias("key")).alias("_key")
    cleaned = fill_for_labels(df.select(apart, *names), names)
    numbers = cleaned.select(
        F.col("_key.key").alias(key), *[F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name) for name in names]
    )
    ends = [
        value.alias(f"{side}{i}")
        for i, name in enumerate(names)
        for side, value in (("low", F.min(name)), ("high", F.max(name)))
    ]
    extremes = numbers.agg(F.struct(*ends).alias("extremes")).scalar()
    scaled = {
        name: _scaled(F.col(name), F.col(f"_x.low{i}"), F.col(f"_x.high{i}")) for i, name in enumerate(names)
    }
    # Plain sums of known columns compile; array functions would be interpreted.
    labels = [
        reduce(add, [F.lit(float(w)) * scaled[name] for name, w in zip(task.columns, task.weights)]).alias(output)
        for output, task in tasks.items()
    ]
    return numbers.withColumn("_x", extremes).select(key, *labels)


def weighted_label(df: DataFrame, key: str, task: LabelTask, output: str = "label") -> DataFrame:
    """(key, label) of one task."""
    return weighted_labels(df, key, {output: task})


def stacked_labels(df: DataFrame, key: str, tasks: Mapping[str, LabelTask]) -> DataFrame:
    """(key, task, label) of several tasks, computed together."""
    wide = weighted_labels(df, key, tasks)
    cells = [F.struct(F.lit(name).alias("task"), F.col(name).alias("label")) for name in tasks]
    return wide.select(key, F.explode(F.array(*cells)).alias("_c")).select(key, "_c.*")


def label_per_class(df: DataFrame, key: str, label: str, classes: int) -> DataFrame:
    """One-vs-rest labels in long form: (class, key, "1"/"0") for 1..classes."""
    numbers = F.explode(F.sequence(F.lit(1), F.lit(classes))).alias("class")
    hit = F.col(label).cast("string").eqNullSafe(F.col("class").cast("string"))
    return df.select(key, label, numbers).select(
        "class", key, F.when(hit, "1").otherwise("0").alias("class_label")
    )


SPLIT_BUCKETS = 1 << 32


def split_bounds(shares: Sequence[float]) -> list[int]:
    """The bucket below which each part ends; the last part ends with the buckets."""
    if not math.isclose(sum(shares), 1.0, abs_tol=1e-9):
        raise ValueError("shares must add up to 1")
    bounds = [round(upper * SPLIT_BUCKETS) for upper in accumulate(shares)]
    bounds[-1] = SPLIT_BUCKETS
    if any(share > 0 and low == high for share, low, high in zip(shares, [0, *bounds], bounds)):
        raise ValueError(f"a share is too small for {SPLIT_BUCKETS} buckets")
    return bounds


def split_by_hash(df: DataFrame, key: str, shares: Mapping[str, float], output: str = "split", salt: str = "") -> DataFrame:
    """Each row tagged with a part by the hash of its key.

    The same key always falls in the same part, on any cluster and on any run;
    rows without a key share one part. Every row is in exactly one part.
    """
    bucket = hash_bucket(F.col(key), SPLIT_BUCKETS, salt)
    bounds = split_bounds(list(shares.values()))
    *firsts, last = shares
    tag = F.lit(last)
    for name, bound in reversed(list(zip(firsts, bounds))):
        tag = F.when(bucket < bound, name).otherwise(tag)
    return df.withColumn(output, tag)


def split_at_random(df: DataFrame, key: str, shares: Sequence[float], seed: int) -> list[DataFrame]:
    """Seeded parts of roughly the given shares.

    The draw is a hash of the seed and the key, so the parts are exact
    complements however often and in whatever order they are computed.
    """
    names = [f"{i}" for i in range(len(shares))]
    tagged = split_by_hash(df, key, dict(zip(names, shares)), "_part", salt=f"/{seed}")
    return [tagged.filter(F.col("_part") == name).drop("_part") for name in names]
