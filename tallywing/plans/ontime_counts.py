"""The older variants of the flight jobs, which rank and tabulate the number of flights on time, not their share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.operators.drops import Drops
from tallywing.operators.lookup import with_name
from tallywing.operators.ontime import airport_traffic, on_time_counts
from tallywing.operators.schedules import schedules
from tallywing.operators.topn import top_n
from tallywing.plans.aviation import ARRIVAL, DEPARTURE


def top_popular_airports(flights: DataFrame, airports: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest by count and id, in ascending order."""
    top = top_n(airport_traffic(flights), [F.desc("flights"), F.desc("airport")], n)
    named = with_name(top, airports, "airport", "airport_name")
    return named.select("airport", "airport_name", "flights").orderBy("flights", "airport")


def top_on_time_airlines(flights: DataFrame, carriers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest by number of arrivals on time and id, in ascending order."""
    counts = on_time_counts(flights, ["airline_id"], ARRIVAL)
    top = top_n(counts, [F.desc("ontime_count"), F.desc("airline_id")], n)
    named = with_name(top, carriers, "airline_id", "airline_name")
    return named.select("airline_id", "airline_name", "ontime_count").orderBy("ontime_count", "airline_id")


def airport_carrier_departures(flights: DataFrame, airports: DataFrame, carriers: DataFrame) -> DataFrame:
    counts = on_time_counts(flights, ["origin", "airline_id"], DEPARTURE)
    counts = counts.withColumnRenamed("ontime_count", "ontime_departures")
    counts = with_name(counts, airports, "origin", "origin_name", "blank")
    return with_name(counts, carriers, "airline_id", "airline_name", "blank")


def airport_dest_departures(flights: DataFrame, airports: DataFrame) -> DataFrame:
    counts = on_time_counts(flights, ["origin", "dest"], DEPARTURE)
    counts = counts.withColumnsRenamed({"dest": "destination", "ontime_count": "ontime_departures"})
    counts = with_name(counts, airports, "origin", "origin_name", "blank")
    return with_name(counts, airports, "destination", "destination_name", "blank")


def source_dest_carrier_arrivals(flights: DataFrame, airports: DataFrame, carriers: DataFrame) -> DataFrame:
    counts = on_time_counts(flights, ["origin", "dest", "airline_id"], ARRIVAL)
    counts = counts.withColumnsRenamed({"dest": "destination", "ontime_count": "ontime_arrivals"})
    counts = with_name(counts, airports, "origin", "origin_name", "blank")
    counts = with_name(counts, airports, "destination", "destination_name", "blank")
    return with_name(counts, carriers, "airline_id", "airline_name", "blank")


def source_dest_schedules(
    flights: DataFrame, airports: DataFrame, carriers: DataFrame, drops: Drops | None = None
) -> DataFrame:
    """Schedules with names."""
    named = with_name(schedules(flights, drops), airports, "origin", "origin_name", "blank")
    named = with_name(named, airports, "destination", "destination_name", "blank")
    return with_name(named, carriers, "airline_id", "airline_name", "blank")
