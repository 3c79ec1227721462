"""Names for ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_name(df: DataFrame, names: DataFrame, key: str, alias: str, unknown: str = "id") -> DataFrame:
    """Add the name of ``key`` as ``alias``; an unknown one gets the id itself, or a blank if ``unknown="blank"``.

    Meant for results: apply it after aggregations and limits. There is no broadcast hint, since nothing bounds the
    list of names: Spark broadcasts it while it is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond.
    """
    named = names.select(F.col("id").alias(f"{alias}_key"), F.col("name").alias(alias))
    fallback = F.col(key).cast("string") if unknown == "id" else F.lit("")
    joined = df.join(named, F.col(key) == F.col(f"{alias}_key"), "left")
    return joined.select(*df.columns, F.coalesce(alias, fallback).alias(alias))
