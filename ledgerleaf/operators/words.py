"""Word lists and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions.text import drop_stop_words, has_digit, split_words
from ledgerleaf.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, is_small
from ledgerleaf.scratch import materialize

_ROW = "_row_number"
#: Stop words, and their bytes, that every task may hold.
HELD_WORDS, HELD_BYTES = 10_000, 1 << 20
#: Combinations of one row that are numbered together.
COMBINATIONS_AT_ONCE = 4096


def remove_stop_words(
    df: DataFrame,
    text: str,
    stop_words: DataFrame,
    output: str = "words",
    separator: str = "|",
    held_words: int = HELD_WORDS,
    held_bytes: int = HELD_BYTES,
    broadcast_words: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Text without stop words and without words that hold a digit.

    ``stop_words`` has one column and may have any size. Only stop words that
    occur in the texts matter. A list measured as fit for a broadcast meets the
    words of the texts where they are, and few of them move; a longer one is
    joined with the texts' distinct words, combined before they move. If what is left is small, measured by words
    and bytes, it becomes a hashed set in the generated code and the texts stay
    where they are. Otherwise the words of the texts are joined (:func:`_joined_out`).
    """
    names = [F.col(f"`{name}`") for name in df.columns]
    stops = stop_words.toDF("_stop").filter(F.col("_stop").isNotNull()).distinct()
    if not is_small(stops, held_words, held_bytes):
        spoken = df.select(F.explode(split_words(F.col(text), separator)).alias("_word"))
        same = F.col("_word") == F.col("_stop")
        if is_small(stops, broadcast_words, broadcast_bytes):
            met = spoken.join(F.broadcast(stops), same, "left_semi").distinct()
        else:
            met = spoken.distinct().join(stops, same, "left_semi")
        stops = materialize(met.toDF("_stop"), "stop-words")
        if not is_small(stops, held_words, held_bytes):
            return _joined_out(df, text, stops, output, separator)
    held = sorted(row["_stop"] for row in stops.collect())
    kept = F.array_join(drop_stop_words(split_words(F.col(text), separator), held), separator)
    return df.select(*names, F.when(F.col(text).isNotNull(), kept).alias(output))


def _joined_out(df: DataFrame, text: str, stops: DataFrame, output: str, separator: str) -> DataFrame:
    """For stop words that no task can hold: every word of the texts meets them
    in a join. Rows are numbered here, so they may repeat each other."""
    # Numbers are fixed by being written.
    rows = materialize(df.withColumn(_ROW, F.monotonically_increasing_id()), "texts")
    words = rows.select(_ROW, F.posexplode(split_words(F.col(text), separator)).alias("_at", "_word"))
    # Null-safe, so that the join has a shuffle of its own and a very common
    # word can be split.
    same = F.col("_word").eqNullSafe(F.col("_stop"))
    kept = words.filter(~has_digit(F.col("_word"))).join(stops, same, "left_anti")
    # The list of one text is as long as that text, which is one row anyway.
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_word")))
    lines = kept.groupBy(_ROW).agg(F.array_join(F.transform(ordered, lambda w: w["_word"]), separator).alias("_line"))
    left = F.when(F.col(text).isNotNull(), F.coalesce(F.col("_line"), F.lit("")))
    return rows.join(lines, _ROW, "left").select(*[F.col(f"`{name}`") for name in df.columns], left.alias(output))


def list_combinations(
    df: DataFrame, text: str, output: str = "combination", list_separator: str = "|", item_separator: str = ","
) -> DataFrame:
    """One row per combination of the lists in ``a,b|c,d``, as an array.

    Combination number i takes, of each list, the item at
    (i / product of the later sizes) modulo its size. Numbers are made in
    stretches, so no row ever holds the whole product. Lists without items
    take no part; a text without any list has no combination.
    """
    one_list = lambda part: split_words(part, item_separator)
    lists = F.filter(F.transform(split_words(F.col(text), list_separator), one_list), lambda items: F.size(items) > 0)
    sizes = F.transform("_lists", lambda items: F.size(items).cast("bigint"))
    later = F.transform(
        "_sizes",
        lambda _, at: F.aggregate(F.slice("_sizes", at + 2, F.size("_sizes")), F.lit(1).cast("bigint"), lambda a, b: a * b),
    )
    total = F.when(F.size("_sizes") > 0, F.get("_later", F.lit(0)) * F.get("_sizes", F.lit(0))).otherwise(0)
    stretch = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("_total") / COMBINATIONS_AT_ONCE) - 1)
    first = F.col("_stretch") * COMBINATIONS_AT_ONCE
    last = F.least(first + COMBINATIONS_AT_ONCE, F.col("_total")) - 1
    pick = F.transform(
        "_lists",
        lambda items, at: F.get(items, (F.floor(F.col("_i") / F.get("_later", at)) % F.get("_sizes", at)).cast("int")),
    )
    numbered = (
        df.withColumn("_lists", lists)
        .withColumn("_sizes", sizes)
        .withColumn("_later", later)
        .withColumn("_total", total)
        .filter("_total > 0")
        .withColumn("_stretch", F.explode(stretch))
        .withColumn("_i", F.explode(F.sequence(first, last)))
    )
    return numbered.select(*[F.col(f"`{name}`") for name in df.columns], pick.alias(output))


def word_counts(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Occurrences of every word over all texts."""
    words = df.select(F.explode(split_words(F.col(text), separator)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
