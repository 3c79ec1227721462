"""Names of airports and carriers from quoted CSV files, as ``(id, name)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.functions.csv import record, unquoted
from tallywing.sources.records import lines_with_places, records


def airport_names(spark: SparkSession, path: str) -> DataFrame:
    return _names(spark, path, 1)


def carrier_names(spark: SparkSession, path: str) -> DataFrame:
    return _names(spark, path, 3)


def _names(spark: SparkSession, path: str, name_at: int) -> DataFrame:
    return names_from_records(records(lines_with_places(spark, path)), name_at)


def names_from_records(rows: DataFrame, name_at: int) -> DataFrame:
    """``(id, name)`` of quoted CSV records (``records``): id first, name at position ``name_at``, NULL where it is blank.

    Of several names of an id the one furthest down the last file counts (files by path).
    """

    def cell(position: int) -> Column:
        return F.nullif(F.regexp_extract("value", record([position], position), 1), F.lit(""))

    named = rows.select(unquoted(cell(0)).alias("id"), unquoted(cell(name_at)).alias("name"), "file", "split", "line")
    return last_named(named, "file", "split", "line")


def last_named(rows: DataFrame, *order: str) -> DataFrame:
    """One name per id: the last by the columns ``order``, such as the path of the file and the line in it."""
    return rows.groupBy("id").agg(F.max_by("name", F.struct(*order)).alias("name"))
