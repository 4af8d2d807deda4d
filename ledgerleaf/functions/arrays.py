"""Vectors held as ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hadamard(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a * b)


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(hadamard(left, right), F.lit(0.0), lambda total, one: total + one)


def weighted_sum(vector: Column, weights: Sequence[float]) -> Column:
    return dot(vector, F.array(*[F.lit(float(weight)) for weight in weights]))


def outer(left: Column, right: Column) -> Column:
    """All products of two short vectors, one inner array per left element."""
    return F.transform(left, lambda a: F.transform(right, lambda b: a * b))


def argmax(vector: Column) -> Column:
    """Position of the first greatest element, counted from zero."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def as_doubles(*values: Column) -> Column:
    """One array from several number or numeric-text columns."""
    return F.array(*[value.try_cast("double") for value in values])
