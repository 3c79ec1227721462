"""Best rows, overall or per key. Orders are given whole, ending in an id, so that ties at a cut are settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps its own first ``n`` and only those move."""
    return df.orderBy(*order).limit(n)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, for keys that hardly repeat.

    Limiting keys ahead of the shuffle would sort every task's rows to drop next to none; this sorts once, behind it.
    """
    before = F.lag(F.lit(1)).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("before", before).filter("before is null").drop("before")


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key in ``order``.

    Spark limits each key to ``k`` rows in every map task ahead of the shuffle, so a hot key moves little.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("place", place).filter(F.col("place") <= k).drop("place")
