"""Words of titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.functions.text import tokens


def words(lines: DataFrame, delimiters: str) -> DataFrame:
    """Lower-cased words of the ``value`` column, one row per occurrence."""
    return lines.select(F.explode(tokens(F.col("value"), delimiters)).alias("word")).select(F.lower("word").alias("word"))


def word_counts(lines: DataFrame, delimiters: str, stop_words: DataFrame | None = None) -> DataFrame:
    """Occurrences per word, without the stop words.

    The anti join is on the counts: Spark moves it ahead of the aggregation where the list can be broadcast, and
    otherwise joins the much smaller counts on the partitioning they already have.
    """
    counts = words(lines, delimiters).groupBy("word").agg(F.count("*").alias("occurrences"))
    return counts if stop_words is None else counts.join(stop_words.select("word"), "word", "left_anti")
