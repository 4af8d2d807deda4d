"""Timestamps given as strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length of one slot, default end of the observed period.
SLOT_SECONDS = 30 * 86400
DEFAULT_END = "2018-09-01 00:00:00"


def _lenient(text: Column) -> Column:
    return text.try_cast("timestamp")


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970 of a timestamp, date or readable string."""
    return F.unix_timestamp(_lenient(moment))


def epoch_millis(text: Column, default: int | None = None) -> Column:
    """Milliseconds since 1970 of the whole second; blank or unreadable text
    gives ``default``."""
    millis = epoch_seconds(text) * F.lit(1000).cast("bigint")
    return millis if default is None else F.coalesce(millis, F.lit(default).cast("bigint"))


def slot30(start: Column, end: str = DEFAULT_END) -> Column:
    """Age of ``start`` at ``end`` in whole 30-day slots.

    A missing or unreadable start counts from 1970. Division truncates.
    """
    begin = F.coalesce(epoch_seconds(start), F.lit(0).cast("bigint"))
    age = F.unix_timestamp(F.lit(end).cast("timestamp")) - begin
    return F.call_function("div", age, F.lit(SLOT_SECONDS).cast("bigint")).cast("int")
