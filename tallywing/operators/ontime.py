"""Counts and ratios over flights. Each is one partial and one final hash aggregation, so a hot key costs nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.functions.parsing import is_on_time


def _totals(flights: DataFrame, keys: list[str], delay_flag: str) -> DataFrame:
    on_time = F.count_if(is_on_time(delay_flag)).alias("ontime_count")
    return flights.groupBy(*keys).agg(on_time, F.count("*").alias("total_count"))


def _with_ratio(totals: DataFrame, keys: list[str]) -> DataFrame:
    ratio = (F.col("ontime_count") / F.col("total_count")).alias("ontime_percentage")
    return totals.select(*keys, ratio, "ontime_count", "total_count")


def on_time_ratios(flights: DataFrame, keys: list[str], delay_flag: str) -> DataFrame:
    """Share of flights on time per key; a flight without a flag (cancelled) counts as late."""
    return _with_ratio(_totals(flights, keys, delay_flag), keys)


def on_time_state(flights: DataFrame, keys: list[str], delay_flag: str) -> DataFrame:
    """What ``ratios_of_state`` needs of ``flights``: two counts for each year and key. States of different years add up."""
    return _totals(flights, ["year", *keys], delay_flag)


def ratios_of_state(state: DataFrame, keys: list[str]) -> DataFrame:
    """The ratios over all flights whose states, put together by union, are ``state``."""
    sums = [F.sum(c).alias(c) for c in ("ontime_count", "total_count")]
    return _with_ratio(state.groupBy(*keys).agg(*sums), keys)


def on_time_counts(flights: DataFrame, keys: list[str], delay_flag: str) -> DataFrame:
    """Number of flights on time per key; keys without any do not appear."""
    return flights.filter(is_on_time(delay_flag)).groupBy(*keys).agg(F.count("*").alias("ontime_count"))


def airport_traffic(flights: DataFrame) -> DataFrame:
    """Departures plus arrivals per airport; blank airports are left out. One scan serves both ends of a flight."""
    ends = flights.select(F.explode(F.array("origin", "dest")).alias("airport"))
    named = F.col("airport") != "" if dict(ends.dtypes)["airport"] == "string" else F.col("airport").isNotNull()
    return ends.filter(named).groupBy("airport").agg(F.count("*").alias("flights"))
