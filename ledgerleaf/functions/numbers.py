"""Numbers: casts, rounding, thresholds, text forms and hashed draws."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column, strict: bool = False) -> Column:
    """Number or numeric text as double; ``strict`` fails on anything else."""
    return value.cast("double") if strict else value.try_cast("double")


def round_half_up(value: Column, scale: int = 5) -> Column:
    """Half-up rounding of the decimal text form of a double."""
    return F.round(value, scale)


def at_least(score: Column, threshold: float) -> Column:
    """1.0 when the score reaches the threshold, else 0.0."""
    return F.when(score >= threshold, 1.0).otherwise(0.0)


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def is_finite(value: Column) -> Column:
    number = value.cast("double")
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))


def plain_number(value: Column) -> Column:
    """Text of a number without an exponent.

    ``12.5`` stays ``12.5``, ``1.5E7`` becomes ``15000000`` and ``1.5E-4``
    becomes ``0.00015``.
    """
    text = value.cast("string")
    head = F.regexp_extract(text, r"^-?([0-9]+)", 1)
    tail = F.regexp_extract(text, r"\.([0-9]+)", 1)
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    digits = F.concat(head, tail)
    shift = power - F.length(tail)
    as_whole = F.concat(digits, F.repeat(F.lit("0"), shift))
    point = F.length(head) + power
    inside = F.concat(F.left(digits, point), F.lit("."), F.substring(digits, point + 1, F.length(digits)))
    below_one = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    spread = F.when(shift >= 0, as_whole).when(point > 0, inside).otherwise(below_one)
    return F.when(~text.contains("E"), text).otherwise(F.concat(sign, spread))


def hashed_uniform(key: Column, salt: str) -> Column:
    """A draw in (0, 1) fixed by the key.

    Unlike ``rand`` the value does not depend on row order or on which
    partition a row is in, so a task that is run again draws the same number.
    """
    bits = F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"/{salt}"))), 1, 8), 16, 10)
    return (bits.cast("bigint") + F.lit(1)) / F.lit(4294967297.0)


def hashed_gaussian(key: Column, salt: str, mean: Column | float = 0.0, variance: Column | float = 1.0) -> Column:
    """Normal draw fixed by the key (Box-Muller over two hashed uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(hashed_uniform(key, f"{salt}/r")))
    angle = F.lit(2.0 * math.pi) * hashed_uniform(key, f"{salt}/a")
    spread = F.sqrt(variance if isinstance(variance, Column) else F.lit(variance))
    return radius * F.cos(angle) * spread + mean


def hash_bucket(key: Column, buckets: int = 1 << 32, salt: str = "") -> Column:
    """Bucket of a key by its md5, the same in every engine and on every run;
    a missing key has the bucket of the empty text."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets
