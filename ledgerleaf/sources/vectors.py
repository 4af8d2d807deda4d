"""Numeric files as vectors."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_matrix(spark: SparkSession, path: str, width: int, sep: str = ",") -> DataFrame:
    """Headerless numeric CSV, one dense vector per line."""
    schema = T.StructType([T.StructField(f"c{i}", T.DoubleType()) for i in range(width)])
    rows = spark.read.schema(schema).option("sep", sep).csv(path)
    return rows.select(array_to_vector(F.array(*rows.columns)).alias("features"))


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """(label, sparse vector). Naming the width saves a pass over the data."""
    return spark.read.format("libsvm").option("numFeatures", features).load(path)
