"""Row numbers, running totals and preceding rows over any amount of ordered data.

A window without a partition key, or with one very large key, would sort all
its rows in a single task. Here rows are dealt by ranges of the order: bounds
are sampled once and become literals, a row's part follows from them and from
its own values alone, and the rows move once to their part. Windows on the part
need no further exchange; what one part must know of those before it is one row
per part.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.scratch import materialize

_PART = "_part"
_ROWS = "_rows"
# Fewer rows than this are one part.
ROWS_PER_PART = 50_000
# Rows sampled for each part.
SAMPLED = 20


@dataclass(frozen=True)
class _Key:
    """One column of the order."""

    name: str
    falling: bool = False
    nulls_last: bool = False

    @property
    def column(self) -> Column:
        return F.col(self.name)

    @property
    def order(self) -> Column:
        if self.falling:
            return self.column.desc_nulls_last() if self.nulls_last else self.column.desc_nulls_first()
        return self.column.asc_nulls_last() if self.nulls_last else self.column.asc_nulls_first()

    def precedes(self, a: Column, b: Column) -> Column:
        """Whether ``a`` comes before ``b``, of two that differ."""
        return F.coalesce(a > b if self.falling else a < b, b.isNull() if self.nulls_last else a.isNull())


# How a column says its order.
_SAID = re.compile(r"Column<'`?([^`' ]+)`? (ASC|DESC) NULLS (FIRST|LAST)'>")
_PLAIN = re.compile(r"Column<'`?([^`' (]+)`?'>")


def _key(item: Column | str) -> _Key:
    if isinstance(item, str):
        return _Key(item)
    said = _SAID.fullmatch(repr(item))
    if said:
        return _Key(said[1], said[2] == "DESC", said[3] == "LAST")
    plain = _PLAIN.fullmatch(repr(item))
    if not plain:
        raise ValueError(f"order by named columns, not by {item!r}")
    return _Key(plain[1])


def _at_or_after(keys: Sequence[_Key], bound: Column) -> Column:
    """Whether a row comes at or after a bound (a struct of the keys' values)."""
    reached = F.lit(True)
    for i, key in reversed(list(enumerate(keys))):
        value = bound[f"b{i}"]
        reached = F.when(value.eqNullSafe(key.column), reached).otherwise(key.precedes(value, key.column))
    return reached


def _part_of(keys: Sequence[_Key], bounds: list[tuple], kinds: list) -> Column:
    """How many bounds a row has reached. They are held in runs of about the
    square root of their number, so a row meets few of them."""
    if not bounds:
        return F.lit(0)

    def typed(rows: list[tuple]) -> Column:
        literal = lambda v, kind: F.lit(bytes(v) if isinstance(v, bytearray) else v).cast(kind)
        return F.array(*[F.struct(*[literal(v, kind).alias(f"b{i}") for i, (v, kind) in enumerate(zip(row, kinds, strict=True))]) for row in rows])

    reached = lambda rows: F.size(F.filter(rows, lambda b: _at_or_after(keys, b)))
    wide = max(1, int(len(bounds) ** 0.5))
    runs = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    run = reached(typed([r[0] for r in runs]))
    within = reached(F.element_at(F.array(*[typed(r) for r in runs]), F.greatest(run, F.lit(1))))
    return F.when(run == 0, 0).otherwise((run - 1) * wide + within)


def _placed(df: DataFrame, keys: Sequence[_Key], parts: int | None) -> tuple[DataFrame, int]:
    """The rows with the number of their part, and how many parts there are.

    The rows are written once before they are sampled, so that no reading of
    them repeats what made them.
    """
    staged = materialize(df, "ordered")
    count = staged.count()
    if parts is None:
        parts = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(count / ROWS_PER_PART))
    if parts <= 1 or count == 0:
        return staged.withColumn(_PART, F.lit(0)), 1
    names = [key.column.alias(f"k{i}") for i, key in enumerate(keys)]
    sample = staged.select(*{key.name: key.column for key in keys}.values())
    share = parts * SAMPLED / count
    if share < 1:
        sample = sample.sample(share, seed=1)
    # About SAMPLED rows of keys for each part.
    rows = sample.orderBy(*[key.order for key in keys]).select(*names).collect()
    bounds = list(dict.fromkeys(_hashable(rows[len(rows) * k // parts]) for k in range(1, parts))) if rows else []
    kinds = [sample.select(key.column).schema[0].dataType for key in keys]
    return staged.withColumn(_PART, _part_of(keys, bounds, kinds)), len(bounds) + 1


def _hashable(row) -> tuple:
    return tuple(bytes(v) if isinstance(v, bytearray) else v for v in row)


def running(
    df: DataFrame,
    order_by: Sequence[Column | str],
    *,
    group_by: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    overall: Mapping[str, str] | None = None,
    row_number: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add inclusive running sums and/or a row number, per group or overall.

    ``totals`` maps a new column to the column summed so far, ``overall`` to
    the column summed over the whole table. The order names columns and must be
    total within a group (add a unique column at the end of ``order_by``). A
    group of any size is spread over as many parts as its rows need. There are
    at most as many parts as shuffle partitions, fewer for small tables, or
    ``parts``.
    """
    totals = dict(totals or {})
    overall = dict(overall or {})
    groups = [F.col(name) for name in group_by]
    keys = [_key(item) for item in order_by]
    staged, n_parts = _placed(df, [*[_Key(name) for name in group_by], *keys], parts)

    moved = staged.repartitionById(n_parts, F.col(_PART))
    here = Window.partitionBy(_PART, *groups).orderBy(*[key.order for key in keys])
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {name: F.sum(source).over(here) for name, source in totals.items()}
    if row_number:
        added[row_number] = F.row_number().over(here).cast("bigint")
    result = moved.withColumns(added)

    if n_parts > 1:
        sums = {name: F.sum(source) for name, source in totals.items()}
        if row_number:
            sums[row_number] = F.count(F.lit(1))
        per_part = staged.groupBy(*groups, _PART).agg(*[value.alias(name) for name, value in sums.items()])
        # One row per part and group; a window over it never exceeds the number
        # of parts for one group.
        earlier = Window.partitionBy(*groups).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
        before = per_part.select(
            *[F.col(name).alias(f"_g{i}") for i, name in enumerate(group_by)],
            F.col(_PART).alias("_p"),
            F.count(F.lit(1)).over(earlier).alias("_prior"),
            *[F.sum(name).over(earlier).alias(f"_before_{name}") for name in sums],
        ).filter(F.col("_prior") > 0)
        # At most one group per part began in an earlier part, so `before` holds
        # at most one row per part and can always be broadcast.
        same = F.col(_PART) == F.col("_p")
        for i, name in enumerate(group_by):
            same = same & F.col(name).eqNullSafe(F.col(f"_g{i}"))
        result = result.join(F.broadcast(before), same, "left")
        result = result.withColumns({name: F.col(name) + F.coalesce(F.col(f"_before_{name}"), F.lit(0)) for name in sums})
    if overall:
        sums_of_all = staged.agg(F.struct(*[F.sum(source).alias(name) for name, source in overall.items()]).alias("all"))
        result = result.withColumn("_all", sums_of_all.scalar()).withColumns(
            {name: F.col(f"_all.{name}") for name in overall}
        )
    return result.select(*df.columns, *added, *overall)


def numbered(df: DataFrame, order_by: Sequence[Column | str], name: str = "line_no", **options) -> DataFrame:
    """Rows with their 1-based position in the given order."""
    return running(df, order_by, row_number=name, **options)


def with_preceding(df: DataFrame, order_by: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Rows with the values of ``order_by`` in the row before them, as a struct;
    null in the first row.

    Rows rise by the named columns, null first. Within a part the row before is
    a neighbour; each part is handed the last row of the parts before it.
    """
    keys = [_key(item) for item in order_by]
    staged, n_parts = _placed(df, keys, parts)
    row = F.struct(*[key.column.alias(key.name) for key in keys])
    neighbour = F.lag(row).over(Window.partitionBy(_PART).orderBy(*[key.order for key in keys]))
    result = staged.repartitionById(n_parts, F.col(_PART)).withColumn(name, neighbour)
    if n_parts > 1:
        # One row per part.
        ends = staged.groupBy(_PART).agg(F.max(row).alias("_end"))
        handed = ends.select(F.col(_PART).alias("_p"), F.lag("_end").over(Window.orderBy(_PART)).alias("_handed"))
        result = result.join(F.broadcast(handed), F.col(_PART) == F.col("_p"), "left")
        result = result.withColumn(name, F.coalesce(F.col(name), F.col("_handed")))
    return result.select(*df.columns, name)
