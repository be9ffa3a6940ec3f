"""A session with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "loomframe", **more: str) -> SparkSession:
    """The running session, or a new one; ``more`` adds settings, dots written as double underscores."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS)
    for key, value in more.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
