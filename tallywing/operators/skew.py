"""Measured spreading of heavy join keys over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many keys are spread: what lies beyond has less than this part of all the work each.
MOST_KEYS = 1024
#: Rows of result that one task may get from a key without it being spread.
SLICE = 1 << 18


def heavy_keys(sizes: DataFrame, keys: Sequence[str], work: str, slice_rows: int = SLICE) -> DataFrame:
    """The ``MOST_KEYS`` keys of the most ``work`` above ``slice_rows``, and in how many ``slices`` to cut each.

    ``sizes`` has one row per key. The bound on the number of keys is what allows the broadcasts of ``sliced``.
    """
    over = sizes.filter(F.col(work) > slice_rows)
    slices = F.ceil(F.col(work) / slice_rows).cast("int").alias("slices")
    return over.orderBy(F.desc(work), *keys).limit(MOST_KEYS).select(*keys, slices)


def sliced(rows: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the ``slices`` of their key, 1 for most. A NULL key is never heavy, as it joins nothing."""
    marked = rows.join(F.broadcast(heavy), list(keys), "left")
    return marked.withColumn("slices", F.coalesce("slices", F.lit(1)))


def dealt(rows: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """One of the slices for each row, by a hash of ``by``, in the column ``slice``."""
    return rows.withColumn("slice", F.pmod(F.xxhash64(*by), F.col("slices")).cast("int")).drop("slices")


def copied(rows: DataFrame) -> DataFrame:
    """A copy of each row for each slice of its key."""
    return rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
