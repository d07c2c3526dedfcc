"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str = "gristmill", master: str | None = None, **settings) -> SparkSession:
    """Adaptive execution on, UTC."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
