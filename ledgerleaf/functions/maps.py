"""Maps and JSON."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_number(text: Column, labels: Mapping[str, int]) -> Column:
    """Number of a label; unknown and missing labels give 0.

    The labels come in falling frequency, so the scan of the literal map ends
    early for most rows.
    """
    if not labels:
        return F.lit(0)
    literal = F.create_map(*[F.lit(item) for item in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(literal, text), F.lit(0))


def json_text(**fields: Column) -> Column:
    """A JSON object with the given fields, in the given order."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
