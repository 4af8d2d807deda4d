"""The field dictionary: how each column of a training table becomes a number,
kept as a long table, so that prediction data is encoded the same way.

There is one row per field and label (key, fieldType, fieldName, label, number);
a field without labels has one row whose label is null. No row or task holds all
labels of a field, so a field may have any number of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.functions.times import epoch_seconds
from ledgerleaf.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, join_unique
from ledgerleaf.operators.ordered import numbered
from ledgerleaf.scratch import materialize

# Field type tags and the length of a shortened label list.
NO_TYPE = "NONE"
NUMERIC_TYPE = "DOUBLE"
STRING_TYPE = "STRING"
DATE_TYPE = "DATE"
TOP_LABELS = 100

SCHEMA = T.StructType(
    [
        T.StructField("key", T.IntegerType()),
        T.StructField("fieldType", T.StringType()),
        T.StructField("fieldName", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("number", T.IntegerType()),
    ]
)


def field_type(kind: T.DataType) -> str:
    if isinstance(kind, T.StringType):
        return STRING_TYPE
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE_TYPE
    return NUMERIC_TYPE


def rank_labels(df: DataFrame, columns: Sequence[str], limit: int | None = None, by: str = "frequency") -> DataFrame:
    """(fieldName, label, number): the labels of each text column.

    ``by="frequency"`` numbers them by falling count (ties by text),
    ``by="value"`` by text. All columns are counted in one pass. All labels are
    numbered, spread over as many tasks as they need; with a ``limit`` labels
    beyond it get no number, and each task keeps at most so many per column
    before the shuffle.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(name).alias("fieldName"), F.col(name).alias("label")) for name in columns])
    )
    counted = (
        df.select(cells.alias("cell"))
        .select("cell.*")
        .filter(F.col("label").isNotNull())
        .groupBy("fieldName", "label")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    order = [F.desc("_n"), F.asc("label")] if by == "frequency" else [F.asc("label")]
    if limit is None:
        ranked = numbered(counted, order, name="number", group_by=["fieldName"])
        return ranked.select("fieldName", "label", F.col("number").cast("int").alias("number"))
    number = F.row_number().over(Window.partitionBy("fieldName").orderBy(*order))
    return (
        counted.withColumn("number", number).filter(F.col("number") <= limit).select("fieldName", "label", "number")
    )


def fit_dictionary(
    df: DataFrame, ignore: Sequence[str] = (), limit: int | None = None, by: str = "frequency"
) -> DataFrame:
    """The dictionary of a table, fitted once and kept in the shared folder.

    Columns in ``ignore`` (key and label) are passed through unchanged. All
    labels are kept unless a ``limit`` (``TOP_LABELS``) is given.
    """
    fields = [field for field in df.schema.fields if field.name not in set(ignore)]
    entries = [(0, NO_TYPE, name) for name in ignore]
    entries += [(i, field_type(field.dataType), field.name) for i, field in enumerate(fields, start=1)]
    # One row per column of the table. An Arrow table becomes rows of the plan
    # itself, which filters remove before anything runs.
    types = {"key": pa.int32(), "fieldType": pa.string(), "fieldName": pa.string()}
    columns = zip(*entries, strict=True) if entries else [[], [], []]
    held = pa.table({name: pa.array(values, kind) for (name, kind), values in zip(types.items(), columns, strict=True)})
    listed = df.sparkSession.createDataFrame(held)
    texts = [name for _, kind, name in entries if kind == STRING_TYPE]
    unlabelled = listed.withColumns({"label": F.lit(None).cast("string"), "number": F.lit(None).cast("int")})
    if not texts:
        return unlabelled
    labels = materialize(rank_labels(df, texts, limit, by), "labels")
    # At most one name per column, from the stored labels. An observation of the
    # rows above would stay in the session, and learners could then send no task.
    with_labels = [row["fieldName"] for row in labels.select("fieldName").distinct().collect()]
    labelled = labels.join(F.broadcast(listed), "fieldName").select(*SCHEMA.fieldNames())
    return labelled.unionByName(unlabelled.filter(~F.col("fieldName").isin(with_labels)))


def label_maps(dictionary: DataFrame) -> DataFrame:
    """(key, fieldType, fieldName, fieldMap): one row per field, for
    dictionaries fitted with a limit; others fail beyond ``BROADCAST_ROWS``
    labels of a field."""
    pairs = F.sort_array(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("number", "label"))))
    most = dictionary.groupBy("fieldName").agg(F.count("label").alias("n")).agg(F.max("n")).first()[0]
    if most and most > BROADCAST_ROWS:
        raise ValueError(f"a field has {most} labels: fit the dictionary with a limit")
    maps = F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["label"], p["number"])))
    return dictionary.groupBy("key", "fieldType", "fieldName").agg(maps.alias("fieldMap"))


def dictionary_lines(dictionary: DataFrame) -> DataFrame:
    """One JSON object per field and label, in the column ``value``."""
    return dictionary.select(F.to_json(F.struct(*SCHEMA.fieldNames())).alias("value"))


def dictionary_fields(dictionary: DataFrame) -> list[Row]:
    """Keys, types and names of the fields on the driver, with the number of
    their labels (``n``) and their bytes (``size``): one row per column of the
    encoded table; labels stay where they are."""
    labels = [F.count("label").alias("n"), F.coalesce(F.sum(F.octet_length("label")), F.lit(0)).alias("size")]
    rows = dictionary.groupBy("key", "fieldType", "fieldName").agg(*labels).collect()
    return sorted(rows, key=lambda row: (row["key"] != 0, row["key"]))


def _encoded(row: Row, number: str) -> Column:
    value = F.col(f"`{row['fieldName']}`")
    kind = row["fieldType"]
    if kind == NO_TYPE:
        return value
    if kind == DATE_TYPE:
        return epoch_seconds(value)
    if kind == STRING_TYPE:
        return F.coalesce(F.col(number), F.lit(0))
    return value.try_cast("double")


def _of_field(labels: DataFrame, name: str, i: int) -> DataFrame:
    own = labels.filter(F.col("fieldName") == name)
    return own.select(F.col("label").alias(f"_label{i}"), F.col("number").alias(f"_number{i}"))


def _by_cells(df: DataFrame, labels: DataFrame, wanted: dict[int, str]) -> DataFrame:
    """Numbers of several large fields at once: the fields' cells are unpivoted
    under a row number, joined with all labels in one join, grouped by row and
    joined back. Only cells move in the first two; a label that most rows have
    can be split."""
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-encode")
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"`{name}`").alias("text")) for name in wanted.values()]))
    long = rows.select("_row", cells.alias("cell")).select("_row", F.struct("cell.field", "cell.text").alias("cell"))
    known = labels.select(F.struct(F.col("fieldName").alias("field"), F.col("label").alias("text")).alias("cell"), "number")
    found = join_unique(long.filter("cell.text is not null"), known, "cell", "inner")
    numbers = found.groupBy("_row").agg(
        *[F.max(F.when(F.col("cell.field") == name, F.col("number"))).alias(f"_number{i}") for i, name in wanted.items()]
    )
    return rows.join(numbers, "_row", "left").drop("_row")


def with_numbers(
    df: DataFrame,
    labels: DataFrame,
    wanted: dict[int, str],
    sizes: Mapping[str, tuple[int, int]],
    small_rows: int = BROADCAST_ROWS,
    small_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with the number of each wanted field's label as ``_number<i>``.

    ``sizes`` has the measured labels and bytes of each field. Fields with few are joined by broadcast, so
    the rows stay where they are; one large field is joined by its text, several
    are joined together as cells.
    """
    left_rows, left_bytes, large = small_rows, small_bytes, {}
    for i, name in sorted(wanted.items(), key=lambda item: sizes[item[1]]):
        n, size = sizes[name]
        if n > left_rows or size > left_bytes:
            large[i] = name
            continue
        left_rows, left_bytes = left_rows - n, left_bytes - size
        df = df.join(F.broadcast(_of_field(labels, name, i)), F.col(f"`{name}`") == F.col(f"_label{i}"), "left").drop(f"_label{i}")
    if len(large) > 1:
        return _by_cells(df, labels, large)
    for i, name in large.items():
        own = _of_field(labels, name, i)
        df = df.join(own, F.col(f"`{name}`").eqNullSafe(F.col(f"_label{i}")), "left").drop(f"_label{i}")
    return df


def encode(df: DataFrame, dictionary: DataFrame, fill: bool = False, **limits: int) -> DataFrame:
    """Columns turned into numbers, passed-through columns first.

    Only the dictionary's columns remain, in its order. ``fill`` sets missing
    numbers to 0. ``limits`` go to :func:`with_numbers`.
    """
    rows = dictionary_fields(dictionary)
    wanted = {i: row["fieldName"] for i, row in enumerate(rows) if row["fieldType"] == STRING_TYPE}
    labels = dictionary.filter(F.col("label").isNotNull())
    sizes = {row["fieldName"]: (row["n"], row["size"]) for row in rows}
    ready = with_numbers(df, labels, wanted, sizes, **limits) if wanted else df
    encoded = ready.select(*[_encoded(row, f"_number{i}").alias(row["fieldName"]) for i, row in enumerate(rows)])
    if not fill:
        return encoded
    return encoded.na.fill(0.0, [row["fieldName"] for row in rows if row["fieldType"] != NO_TYPE])
