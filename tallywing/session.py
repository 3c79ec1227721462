"""A session with the settings the jobs expect; any session with adaptive execution on will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tallywing") -> SparkSession:
    """Master, memory and shuffle partitions come from spark-submit; only semantics and adaptivity are set here."""
    return (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )

