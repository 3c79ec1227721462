"""Jobs over flights: popularity, punctuality, schedules and trips.

``airports`` and ``carriers`` are lists ``(id, name)``. Names are joined to results, after the aggregations and limits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.operators.drops import Drops
from tallywing.operators.lookup import with_name
from tallywing.operators.ontime import airport_traffic, on_time_counts, on_time_ratios
from tallywing.operators.schedules import flight_delays, schedules
from tallywing.operators.topn import top_n
from tallywing.operators.trips import best_trips_of_any_day, connecting_trips

ARRIVAL = "arr_del15"
DEPARTURE = "dep_del15"


def _destination(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("dest", "destination")


def top_popular_airports(flights: DataFrame, airports: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` busiest airports, busiest first; equal counts are all kept, the lower id first."""
    order = [F.desc("flights"), F.asc("airport")]
    top = with_name(top_n(airport_traffic(flights), order, n), airports, "airport", "airport_name")
    return top.select("airport", "airport_name", "flights").orderBy(*order)


def top_on_time_airlines(flights: DataFrame, carriers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` airlines of the highest share of arrivals on time, best first; equal shares in order of id."""
    return top_airlines_of(on_time_ratios(flights, ["airline_id"], ARRIVAL), carriers, n)


def top_airlines_of(ratios: DataFrame, carriers: DataFrame, n: int = 10) -> DataFrame:
    """As ``top_on_time_airlines``, of ratios that are there already."""
    order = [F.desc("ontime_percentage"), F.asc("airline_id")]
    top = top_n(ratios, order, n)
    named = with_name(top, carriers, "airline_id", "airline_name")
    columns = ["airline_id", "airline_name", "ontime_percentage", "ontime_count", "total_count"]
    return named.select(*columns).orderBy(*order)


def top_airport_carriers(flights: DataFrame) -> DataFrame:
    """Departures on time per origin and airline."""
    return on_time_counts(flights, ["origin", "airline_id"], DEPARTURE)


def top_airport_destinations(flights: DataFrame) -> DataFrame:
    """Departures on time per origin and destination."""
    return _destination(on_time_counts(flights, ["origin", "dest"], DEPARTURE))


def top_source_dest_carriers(flights: DataFrame) -> DataFrame:
    """Arrivals on time per origin, destination and airline."""
    return _destination(on_time_counts(flights, ["origin", "dest", "airline_id"], ARRIVAL))


def source_dest_flight_delays(flights: DataFrame, grouped: bool = True) -> DataFrame:
    return flight_delays(flights, grouped)


def connecting_flights(
    flights: DataFrame,
    gap_days: int = 2,
    second_leg_time: str = "arr_time",
    allow_return: bool = False,
    salts: int | None = None,
    drops: Drops | None = None,
) -> DataFrame:
    """Best trip per origin, layover and destination over all days, none leading back; the second leg lands after noon."""
    return best_trips_of_any_day(flights, gap_days, second_leg_time, allow_return, salts, drops=drops)


def airport_carrier_ontime(
    flights: DataFrame, airports: DataFrame, carriers: DataFrame, delay_flag: str = DEPARTURE
) -> DataFrame:
    table = on_time_ratios(flights, ["origin", "airline_id"], delay_flag)
    table = with_name(table, airports, "origin", "origin_name", "blank")
    return with_name(table, carriers, "airline_id", "airline_name", "blank")


def airport_dest_ontime(flights: DataFrame, airports: DataFrame, delay_flag: str = DEPARTURE) -> DataFrame:
    table = _destination(on_time_ratios(flights, ["origin", "dest"], delay_flag))
    table = with_name(table, airports, "origin", "origin_name", "blank")
    return with_name(table, airports, "destination", "destination_name", "blank")


def source_dest_carrier_ontime(
    flights: DataFrame, airports: DataFrame, carriers: DataFrame, delay_flag: str = DEPARTURE
) -> DataFrame:
    table = _destination(on_time_ratios(flights, ["origin", "dest", "airline_id"], delay_flag))
    table = with_name(table, airports, "origin", "origin_name", "blank")
    table = with_name(table, airports, "destination", "destination_name", "blank")
    return with_name(table, carriers, "airline_id", "airline_name", "blank")


def source_dest_schedules(flights: DataFrame, drops: Drops | None = None) -> DataFrame:
    return schedules(flights, drops)


def connecting_flights_by_day(
    flights: DataFrame,
    gap_days: int = 2,
    second_leg_time: str = "dep_time",
    allow_return: bool = True,
    salts: int | None = None,
    drops: Drops | None = None,
) -> DataFrame:
    """Best trip per first-leg day, origin, layover and destination; the second leg departs after noon."""
    return connecting_trips(flights, gap_days, second_leg_time, allow_return, salts, drops=drops)
