"""Titles and the small lists that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.operators.drops import Drops, kept


def lines_from_text(spark: SparkSession, path: str) -> DataFrame:
    """One title per line, in the column ``value``."""
    return spark.read.text(path)


def stop_words_from_text(spark: SparkSession, path: str) -> DataFrame:
    return stop_words_from_lines(spark.read.text(path))


def stop_words_from_lines(lines: DataFrame) -> DataFrame:
    """One word per line, taken exactly as written, in the column ``word``."""
    return lines.select(F.col("value").alias("word"))


def delimiters_from_text(spark: SparkSession, path: str) -> str:
    return delimiters_from_lines(spark.read.text(path))


def delimiters_from_lines(lines: DataFrame) -> str:
    """All characters of the lines; a pattern has to be known when the plan is made."""
    distinct = lines.select(F.explode(F.split("value", "")).alias("c")).distinct()
    return "".join(sorted(row.c for row in distinct.toLocalIterator()))


def league_from_text(spark: SparkSession, path: str, drops: Drops | None = None) -> DataFrame:
    return league_from_lines(spark.read.text(path), drops)


def league_from_lines(lines: DataFrame, drops: Drops | None = None) -> DataFrame:
    """One page id per line, blanks around it allowed, in the column ``page``, each id once; other lines are dropped."""
    ids = lines.select(F.trim("value").try_cast("bigint").alias("page"))
    return kept(ids, drops, league_id_is_a_number=F.col("page").isNotNull()).distinct()
