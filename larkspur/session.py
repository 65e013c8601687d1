"""Session defaults: UTC, ANSI, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; `conf` wins. Shuffle partitions are left to AQE to coalesce."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
