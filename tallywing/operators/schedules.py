"""Projections of flights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.operators.drops import Drops, kept
from tallywing.operators.topn import first_per_key


def schedules(flights: DataFrame, drops: Drops | None = None) -> DataFrame:
    """Scheduled flights by airline, date (yyyymmdd) and flight number.

    Rows whose date text has not 10 characters, or with a missing number, are dropped. Where one flight number flies
    several legs on a day, the one departing first stays.
    """
    dated = kept(flights, drops, date_has_ten_characters=F.length(F.trim("flight_date")) == 10)
    rows = dated.select(
        "airline_id",
        (F.col("year") * 10000 + F.col("month") * 100 + F.col("day")).alias("flight_date"),
        "flight_num",
        "origin",
        F.col("dest").alias("destination"),
        F.col("crs_dep_time").alias("depart_time"),
        F.col("crs_arr_time").alias("arrival_time"),
    )
    rules = {"date": "flight_date", "flight_number": "flight_num", "departure": "depart_time", "arrival": "arrival_time"}
    rows = kept(rows, drops, **{f"{rule}_is_a_number": F.col(c).isNotNull() for rule, c in rules.items()})
    order = [F.col(c) for c in ("depart_time", "origin", "destination", "arrival_time")]
    return first_per_key(rows, ["airline_id", "flight_date", "flight_num"], order)


def flight_delays(flights: DataFrame, grouped: bool = True) -> DataFrame:
    """Flight number and arrival delay flag of every flight, under its route and date, with nothing parsed or dropped.

    ``grouped`` (the default) brings the rows of one route and date together by sorting. The flight number takes part in
    the sort, so that even one large group is divided among tasks.
    """
    rows = flights.select("origin", "dest", "flight_date", "flight_num", "arr_del15")
    return rows.orderBy("origin", "dest", "flight_date", "flight_num") if grouped else rows
