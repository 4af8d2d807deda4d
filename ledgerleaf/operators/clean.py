"""Filling of missing values and sentinels. Every rule set works on whole
tables in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts and numbers that stand for "missing" in the inputs.
BLANK = ""
NULL_TEXTS = ("null", "NULL")
SENTINEL_TEXT = "-9999"
SENTINEL_NUMBER = -9999
ZERO_TEXT = "0.0"


def _fill(
    df: DataFrame,
    null_text: str,
    texts: Mapping[str, str],
    numbers: Mapping[int, int],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Null fills apply to all columns, replacements only to ``columns``."""
    chosen = set(df.columns if columns is None else columns)

    def cleaned(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            result = F.coalesce(value, F.lit(null_text))
            if field.name in chosen:
                for new in dict.fromkeys(texts.values()):
                    olds = [old for old, target in texts.items() if target == new]
                    result = F.when(result.isin(*olds), F.lit(new)).otherwise(result)
        elif isinstance(field.dataType, T.NumericType):
            kind = field.dataType
            result = F.coalesce(value, F.lit(0).cast(kind))
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                result = F.nanvl(result, F.lit(0).cast(kind))
            if field.name in chosen:
                for old, new in numbers.items():
                    result = F.when(result == old, F.lit(new).cast(kind)).otherwise(result)
        else:
            return value
        return result.alias(field.name)

    return df.select(*[cleaned(field) for field in df.schema.fields])


def fill_for_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing text becomes ``"0.0"``, missing numbers 0; in ``columns`` blanks,
    null texts and the numeric sentinel become zero too."""
    texts = dict.fromkeys((BLANK, *NULL_TEXTS), ZERO_TEXT)
    return _fill(df, ZERO_TEXT, texts, {SENTINEL_NUMBER: 0}, columns)


def fill_blank(df: DataFrame) -> DataFrame:
    """Missing, null and sentinel texts become blank, missing and sentinel
    numbers 0."""
    texts = dict.fromkeys((*NULL_TEXTS, SENTINEL_TEXT), BLANK)
    return _fill(df, BLANK, texts, {SENTINEL_NUMBER: 0})


def fill_zero(df: DataFrame) -> DataFrame:
    """Missing, blank and ``"null"`` texts become ``"0.0"``, missing numbers 0."""
    return _fill(df, ZERO_TEXT, {BLANK: ZERO_TEXT, "null": ZERO_TEXT}, {})


def fill_zero_and_sentinels(df: DataFrame) -> DataFrame:
    """As :func:`fill_zero`, and ``"NULL"`` becomes ``"0.0"``, the sentinel text
    ``"0"`` and the sentinel number 0."""
    texts = dict.fromkeys((BLANK, *NULL_TEXTS), ZERO_TEXT) | {SENTINEL_TEXT: "0"}
    return _fill(df, ZERO_TEXT, texts, {SENTINEL_NUMBER: 0})


def zero_to_one(df: DataFrame) -> DataFrame:
    """Zeros of every numeric column become one."""

    def changed(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            return F.when(value == 0, F.lit(1).cast(field.dataType)).otherwise(value).alias(field.name)
        return value

    return df.select(*[changed(field) for field in df.schema.fields])
