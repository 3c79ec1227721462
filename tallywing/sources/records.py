"""Records of quoted CSV files that may go on over several lines, read by many tasks a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines_with_places(spark: SparkSession, path: str) -> DataFrame:
    """``value``, ``file``, ``split`` (where the task's part of the file begins) and ``line`` (which grows within a split)."""
    lines = spark.read.option("lineSep", "\n").text(path)
    places = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    return lines.select("value", *places, F.monotonically_increasing_id().alias("line"))


def records(lines: DataFrame) -> DataFrame:
    """``value`` of each record, with ``file``, ``split`` and ``line`` of its first line. Blank lines are no records.

    A line begins a record if the quotes before it are even in number. Quotes are counted for each split, of which a file
    has few; what lies before a split is a sum over those. Lines that begin no record join the one that began last, which
    may be splits away. No task reads more than a split, and only records are brought together. A quote that is never
    closed makes one record of the rest of its file.
    """
    file, split = ["file"], ["file", "split"]
    odd = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.withColumn("quotes", odd)
    earlier = Window.partitionBy(*file).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = counted.groupBy(*split).agg(F.sum("quotes").alias("own"))
    sums = sums.select(*split, F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"))
    above = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    open_ = (F.col("before") + F.coalesce(F.sum("quotes").over(above), F.lit(0))) % 2 == 1
    begun = counted.join(sums, split).withColumn("begins", F.when(~open_, F.struct("split", "line")))
    here = Window.partitionBy(*split).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    last = begun.groupBy(*split).agg(F.max("begins").alias("last"))
    carried = last.select(*split, F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    owned = begun.withColumn("of", F.last("begins", ignorenulls=True).over(here)).join(carried, split)
    owned = owned.select("file", "split", "line", "value", F.coalesce("of", "carried").alias("of"))
    parts = owned.groupBy("file", "of").agg(F.sort_array(F.collect_list(F.struct("split", "line", "value"))).alias("parts"))
    value = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    whole = parts.select(F.regexp_replace(value, r"\r\z", "").alias("value"), "file", "of.split", "of.line")
    return whole.filter("value <> ''")
