"""Key -> query and key -> SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

FAMILIES = (
    "reading",
    "writing",
    "shaping",
    "joining",
    "grouping",
    "scalars",
    "labeling",
    "importing",
    "training",
    "evaluating",
    "vectors",
    "streams",
)

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a key, with its SQL if there is one."""

    def register(function: Query) -> Query:
        if name in _queries:
            raise ValueError(f"{name} is registered twice")
        _queries[name] = function
        if sql is not None:
            _sql[name] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for family in FAMILIES:
        importlib.import_module(f"ledgerleaf.catalog.{family}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
