"""Delimited text: typed CSV, all-text tables and packed lines."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.scratch import materialize

# Fields before the packed part of a line, and the text of a
# rejected line.
PACKED_AT = 2
REJECT_SIZE = "invalid row size: "
REJECT_CONTENT = ", content: "


def read_csv(
    spark: SparkSession, path: str, sep: str = ",", schema: T.StructType | str | None = None, trim: bool = False
) -> DataFrame:
    """CSV with a header line.

    Give a schema for large inputs: without one Spark reads the data once more
    to infer the types. ``trim`` strips blanks around the fields.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; nothing is read."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a file, or of a folder's first file by name that has one."""
    for file in sorted(spark.read.text(path).inputFiles()):
        row = spark.read.text(file).first()
        if row is not None:
            return row[0]
    raise ValueError(f"no header line in {path}")


def _fields(line: Column, sep: str) -> Column:
    return F.split(line, sep, -1)


def _text_columns(fields: Column, names: Sequence[str]) -> list[Column]:
    return [F.get(fields, F.lit(i)).alias(name) for i, name in enumerate(names)]


def _rows(lines: DataFrame, names: Sequence[str], sep: str) -> DataFrame:
    split = lines.select(_fields(F.col("value"), sep).alias("_f")).filter(F.size("_f") == len(names))
    return split.select(*_text_columns(F.col("_f"), names))


def read_text_table(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """All-text table whose first line names the columns.

    ``sep`` is a regular expression. Every line equal to the header is left
    out, so each file of a folder may repeat it; lines of another width are
    left out too.
    """
    header = first_line(spark, path)
    lines = spark.read.text(path).filter(F.col("value") != header)
    return _rows(lines, re.split(sep, header), sep)


def read_text_rows(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """All-text table without a header line; lines of another width are left
    out."""
    return _rows(spark.read.text(path), names, sep)


def read_text_with_header_file(
    spark: SparkSession, header_path: str, data_path: str, header_sep: str = ",", sep: str = "\t"
) -> DataFrame:
    """All-text table whose column names are in a file of their own."""
    return read_text_rows(spark, data_path, re.split(header_sep, first_line(spark, header_path)), sep)


def parse_packed(lines: DataFrame, width: int, sep: str = "\t") -> DataFrame:
    """(fields, valid) of lines ``a<TAB>b<TAB>packed``, the packed part split
    by ``sep``.

    A line is valid when it has ``width`` fields in the end. Empty lines are
    left out; lines too short to have a packed part are invalid.
    """
    outer = lines.filter(F.col("value") != "").select(F.split("value", "\t", -1).alias("_o"))
    packed = F.concat(F.slice("_o", 1, PACKED_AT), _fields(F.get("_o", F.lit(PACKED_AT)), sep))
    complete = F.size("_o") > PACKED_AT
    fields = F.when(complete, packed).otherwise(F.col("_o"))
    return outer.select(fields.alias("fields"), complete.alias("_c")).select(
        "fields", (F.col("_c") & (F.size("fields") == width)).alias("valid")
    )


def valid_rows(parsed: DataFrame, names: Sequence[str]) -> DataFrame:
    return parsed.filter("valid").select(*_text_columns(F.col("fields"), names))


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """One line of text per invalid row, in the column ``value``."""
    text = F.concat(
        F.lit(REJECT_SIZE), F.size("fields").cast("string"), F.lit(REJECT_CONTENT), F.array_join("fields", ",")
    )
    return parsed.filter(~F.col("valid")).select(text.alias("value"))


def read_packed(
    spark: SparkSession,
    header_path: str,
    data_path: str,
    rejects_path: str,
    header_sep: str = ",",
    sep: str = "\t",
) -> DataFrame:
    """Valid rows of a packed file; the others are written to ``rejects_path``.

    The file is parsed once: both outputs come from the same flagged table.
    """
    names = re.split(header_sep, first_line(spark, header_path))
    parsed = materialize(parse_packed(spark.read.text(data_path), len(names), sep), "packed")
    rejected_lines(parsed).write.mode("overwrite").text(rejects_path)
    return valid_rows(parsed, names)
