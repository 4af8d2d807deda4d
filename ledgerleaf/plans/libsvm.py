"""From a table of mixed columns to libsvm lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerleaf.operators.clean import fill_zero
from ledgerleaf.operators.dictionary import dictionary_lines, encode, fit_dictionary
from ledgerleaf.operators.features import libsvm_table
from ledgerleaf.operators.joins import join_checked
from ledgerleaf.sinks.files import write_libsvm, write_text


def fit(data: DataFrame, key: str, label: str) -> DataFrame:
    """The stored dictionary of a training table, fitted after its missing
    values are filled."""
    return fit_dictionary(fill_zero(data), ignore=[key, label])


def convert(
    data: DataFrame, key: str, label: str, dictionary: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(key, line) table and the dictionary used.

    Without a dictionary one is fitted; prediction data is given the
    dictionary of its training table.
    """
    used = fit(data, key, label) if dictionary is None else dictionary
    return libsvm_table(encode(fill_zero(data), used), key, label), used


def convert_labeled(
    features: DataFrame, labels: DataFrame, key: str, label: str, dictionary: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """As :func:`convert`, for labels kept in a table of their own. Features have
    one row per key; a key that repeats fails."""
    joined = join_checked({"labels": labels.select(key, label), "features": features}, key)
    return convert(joined, key, label, dictionary)


def export(data: DataFrame, path: str, key: str, label: str, dictionary: DataFrame | None = None) -> DataFrame:
    """Convert and write ``.libsvm``, ``.index``, ``.name`` and, when it was
    fitted here, the dictionary as ``.obj``; returns the dictionary."""
    lines, used = convert(data, key, label, dictionary)
    write_libsvm(lines, path, key, data.columns)
    if dictionary is None:
        write_text(dictionary_lines(used), f"{path}.obj")
    return used
