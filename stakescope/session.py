"""A session with the settings that this library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; shuffle partitions are left to the cluster unless given in conf (dots as __)."""
    builder = SparkSession.builder.appName("stakescope")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
