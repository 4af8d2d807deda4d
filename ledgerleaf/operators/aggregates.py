"""Grouped results. Counts, sums and extremes are combined on the map side, so
the shuffle carries one row per key and map task even when one key is very
large."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def history(
    df: DataFrame, keys: Sequence[str], averages: Mapping[str, str], count_name: str = "count_id", scale: int | None = None
) -> DataFrame:
    """Rows and averages per key, all results as text.

    ``averages`` maps a source column to the result name. With ``scale`` sums
    are rounded to that many digits and averages to four more, so that the text
    does not depend on the order in which partial sums meet.
    """
    rows = F.count(F.lit(1))
    means = []
    for source, name in averages.items():
        value = F.col(source).try_cast("double")
        if scale is None:
            mean = F.avg(value)
        else:
            # Divided as decimals, so that a tie in the last digit is a tie.
            total = F.round(F.sum(value), scale).cast(f"decimal(28,{scale})")
            mean = F.round(F.try_divide(total, F.count(value).cast("decimal(20,0)")), scale + 4).cast("double")
        means.append(mean.cast("string").alias(name))
    return df.groupBy(*keys).agg(rows.cast("string").alias(count_name), *means)


def sums_and_averages(df: DataFrame, key: str, columns: Sequence[str], scale: int | None = None) -> DataFrame:
    """``sum_c`` and ``avg_c`` of each column per key, in one pass.

    With ``scale`` the sum is rounded to that many digits and the average is
    taken from it: the result is then the same on every run.
    """
    results = []
    for name in columns:
        value = F.col(name).try_cast("double")
        total = F.sum(value) if scale is None else F.round(F.sum(value), scale)
        mean = F.avg(value) if scale is None else F.try_divide(F.round(F.sum(value), scale), F.count(value))
        results += [total.alias(f"sum_{name}"), mean.alias(f"avg_{name}")]
    return df.groupBy(key).agg(*results)


def _rank_of_mode(count: Column, value: Column, output: Column) -> Column:
    """Smallest struct = highest count, then lowest value, missing value last."""
    return F.struct((-count).alias("n"), value.isNull().alias("missing"), output.alias("value"))


def mode(df: DataFrame, key: str, column: str) -> DataFrame:
    """Most frequent value per key; a missing value can be the most frequent.

    Ties go to the lowest value.
    """
    counted = df.groupBy(key, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(_rank_of_mode(F.col("_n"), F.col(column), F.col(column)))
    return counted.groupBy(key).agg(best.alias("_best")).select(key, F.col("_best.value").alias(column))


@dataclass(frozen=True)
class Period:
    """Rows that a set of features is made of: where ``rows`` holds (everywhere
    without it), result names begin with ``prefix``."""

    rows: Column | None
    sum_columns: Sequence[str] = ()
    prefix: str = ""


def period_features(
    df: DataFrame, key: str, mode_columns: Sequence[str], periods: Sequence[Period], scale: int | None = None
) -> DataFrame:
    """Most frequent value of each mode column, then ``sum_c`` and ``avg_c`` of
    each sum column, per key and period, in one pass over ``df``.

    A row belongs to the first period that takes it. The mode columns are laid
    under each other, marked with period and slot, and counted together; the
    numbers ride along with the first slot. A cell is a struct with one field
    per data type, so values of any type that can be grouped are counted as they
    are (arrays, structs and times too). The winners are put back side by side in
    the second group, so there are one shuffle of the rows and one of combined rows
    for any number of columns and periods, and no join. A key without rows in a period has nulls
    there, a key without rows in any is left out.
    """
    if not mode_columns:
        raise ValueError("no mode columns; use sums_and_averages")
    kinds = {name: df.schema[name].dataType for name in mode_columns}
    fields = {kind: f"t{i}" for i, kind in enumerate(dict.fromkeys(kinds.values()))}
    numbers = list(dict.fromkeys(name for period in periods for name in period.sum_columns))

    def cell(slot: int, name: str) -> Column:
        typed = [
            (F.col(name) if kind == kinds[name] else F.lit(None).cast(kind)).alias(field) for kind, field in fields.items()
        ]
        riding = [
            (F.col(c).try_cast("double") if slot == 0 else F.lit(None).cast("double")).alias(f"v{j}")
            for j, c in enumerate(numbers)
        ]
        return F.struct(F.lit(slot).alias("slot"), *typed, *riding)

    taken = F.lit(None).cast("int")
    for i, period in reversed(list(enumerate(periods))):
        taken = F.lit(i) if period.rows is None else F.when(period.rows, i).otherwise(taken)
    cells = F.explode(F.array(*[cell(i, name) for i, name in enumerate(mode_columns)]))
    partial = [F.count(F.lit(1)).alias("_n")]
    for j, _ in enumerate(numbers):
        partial += [F.sum(f"cell.v{j}").alias(f"_s{j}"), F.count(f"cell.v{j}").alias(f"_c{j}")]
    # Rows of a key meet before they become cells, so that their cells combine in
    # one task; a key that holds much of the table is split by the rebalancing.
    laid = df.hint("rebalance", F.col(key)).select(F.col(key), taken.alias("_period"), cells.alias("cell")).filter(F.col("_period").isNotNull())
    counted = laid.groupBy(key, "_period", "cell.slot", *[f"cell.{field}" for field in fields.values()]).agg(*partial)

    results, shown = [], []
    for p, period in enumerate(periods):
        inside = F.col("_period") == p
        for i, name in enumerate(mode_columns):
            value = F.col(fields[kinds[name]])
            results.append(F.min(F.when(inside & (F.col("slot") == i), _rank_of_mode(F.col("_n"), value, value))).alias(f"_best{p}_{i}"))
            shown.append(F.col(f"_best{p}_{i}.value").alias(f"{period.prefix}{name}"))
        for name in period.sum_columns:
            j = numbers.index(name)
            total = F.sum(F.when(inside, F.col(f"_s{j}")))
            total = total if scale is None else F.round(total, scale)
            both = (f"{period.prefix}sum_{name}", f"{period.prefix}avg_{name}")
            results += [total.alias(both[0]), F.try_divide(total, F.sum(F.when(inside, F.col(f"_c{j}")))).alias(both[1])]
            shown += [F.col(both[0]), F.col(both[1])]
    # The winners meet by a shuffle of their own, of one combined row for each key and
    # task: an expression of the key is not taken for where its rows already lie.
    alone = counted.withColumn(key, F.element_at(F.array(F.col(key)), 1))
    return alone.groupBy(key).agg(*results).select(key, *shown)


def modes_and_sums(
    df: DataFrame, key: str, mode_columns: Sequence[str], sum_columns: Sequence[str] = (), scale: int | None = None
) -> DataFrame:
    """:func:`period_features` of all rows."""
    return period_features(df, key, mode_columns, [Period(None, sum_columns)], scale)


def modes(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each column per key, in one pass over ``df``."""
    return modes_and_sums(df, key, columns)


def top_row(df: DataFrame, key: str | Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row of each key in a total order.

    Spark cuts each map task down to one row per key before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def count_by_key(df: DataFrame, key: str, name: str = "key_count") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def tags_to_columns(
    df: DataFrame, key: str, tag: str, value: str, tags: Sequence[str] | None = None, blank: str = ""
) -> DataFrame:
    """One row per key and one text column per tag.

    Missing cells are blank; of several values the greatest is kept, which is
    never the blank one. Without ``tags`` they are read from the table in
    sorted order; the number of columns is limited by
    ``spark.sql.pivotMaxValues``, above which the job fails.
    """
    if tags is None:
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        found = df.select(tag).filter(F.col(tag).isNotNull()).distinct().limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"more than {limit} tags; raise spark.sql.pivotMaxValues")
        tags = sorted(row[0] for row in found)
    cells = [
        F.coalesce(F.max(F.when(F.col(tag) == one, F.col(value).cast("string"))), F.lit(blank)).alias(one)
        for one in tags
    ]
    return df.groupBy(key).agg(*cells)


def collected_in_chunks(
    df: DataFrame, key: str, position: str, value: Column, width: int, name: str = "values"
) -> DataFrame:
    """All values of a key as arrays, in pieces of bounded length.

    ``position`` is a whole number that is unique within the key; a piece
    spans ``width`` positions, so no array has more than ``width`` elements
    however large the key is. Pieces are ordered by ``chunk``.
    """
    at = F.col(position).cast("bigint")
    start = at - F.pmod(at, F.lit(width).cast("bigint"))
    pieces = df.select(
        key,
        F.call_function("div", start, F.lit(width).cast("bigint")).alias("chunk"),
        F.struct(F.col(position).alias("at"), value.alias("value")).alias("_item"),
    )
    ordered = F.sort_array(F.collect_list("_item"))
    return pieces.groupBy(key, "chunk").agg(F.transform(ordered, lambda item: item["value"]).alias(name))


def column_statistics(
    df: DataFrame, columns: Sequence[str], weight: str | None = None, scale: int | None = None, missing: str = "refuse"
) -> DataFrame:
    """One row per column: mean, unbiased variance, count, non-zeros, extremes
    and norms, optionally weighted (reliability weights).

    One pass with Spark's mergeable vector summary; a row with weight 0 is
    left out. ``missing="skip"`` leaves out rows in which a column is missing,
    ``"refuse"`` fails on them.
    """
    if missing not in ("refuse", "skip"):
        raise ValueError("missing must be 'refuse' or 'skip'")
    if missing == "skip":
        df = df.na.drop(subset=list(columns))
    metrics = ("mean", "variance", "count", "numNonZeros", "max", "min", "normL1", "normL2")
    vector = array_to_vector(F.array(*[F.col(name).cast("double") for name in columns]))
    weights = None if weight is None else F.col(weight).cast("double")
    rows = df if weight is None else df.filter(weights > 0)
    summary = rows.select(Summarizer.metrics(*metrics).summary(vector, weights).alias("s"))
    lists = {name: vector_to_array(F.col(f"s.{name}")) for name in metrics if name != "count"}
    wide = summary.select(F.col("s.count").alias("count"), *[value.alias(name) for name, value in lists.items()])
    long = wide.select(
        "count",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), *[F.col(name)[i].alias(name) for name in lists])
                    for i, c in enumerate(columns)
                ]
            )
        ).alias("r"),
    )

    def shown(name: str) -> Column:
        return F.col(f"r.{name}") if scale is None else F.round(F.col(f"r.{name}"), scale)

    return long.select(
        "r.column",
        shown("mean").alias("mean"),
        shown("variance").alias("variance"),
        "count",
        F.col("r.numNonZeros").cast("bigint").alias("num_nonzeros"),
        "r.max",
        "r.min",
        shown("normL1").alias("norm_l1"),
        shown("normL2").alias("norm_l2"),
    )


def counted_beside(df: DataFrame, name: str, value: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and a counter that is filled while a job reads them.

    Spark keeps the counter in the session of ``df``, and learners cannot send
    such a session to their tasks: read ``df`` in a ``spark.newSession()`` when
    the program also fits or applies models.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total")), observation


def mean_variance_deviation(df: DataFrame, column: str, scale: int | None = None) -> DataFrame:
    value = F.col(column).cast("double")
    results = {"mean": F.avg(value), "variance": F.var_samp(value), "deviation": F.stddev_samp(value)}
    return df.agg(*[(v if scale is None else F.round(v, scale)).alias(k) for k, v in results.items()])
