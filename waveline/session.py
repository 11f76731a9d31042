"""The session the engine is tuned for; an existing one is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "waveline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times, adaptive execution and skew handling."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
