"""Session builder for jobs, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "ledgerleaf", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and ANSI casts.

    Keyword arguments use ``__`` for dots: ``spark__ui__enabled="false"``.
    Cluster sizing (partitions, memory, checkpoint folder) is left to the
    submit command.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key even where that costs one more shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
