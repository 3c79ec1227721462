"""Flight records: comma-separated text in three layouts, or a Parquet table partitioned by year.

Every reader gives the columns of ``COMPACT`` (those the layout holds) as text, blank where the file has nothing.
``parse_flights`` turns them into typed columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.functions.csv import unquoted, wanted_fields
from tallywing.functions.parsing import day_of, double_or_null, int_or_null, whole_part
from tallywing.operators.drops import Drops, kept

# The file layouts, in column order.
COMPACT = [
    "year",
    "month",
    "day",
    "flight_date",
    "airline_id",
    "flight_num",
    "origin",
    "dest",
    "crs_dep_time",
    "dep_time",
    "dep_del15",
    "crs_arr_time",
    "arr_time",
    "arr_delay",
    "arr_del15",
    "cancelled",
]
SHORT = [
    "flight_date",
    "airline_id",
    "flight_num",
    "origin",
    "dest",
    "crs_dep_time",
    "dep_del15",
    "crs_arr_time",
    "arr_del15",
]
# Position in the 55-column layout of each compact column.
FULL_WIDTH = 55
FULL_POSITIONS = {
    "year": 0,
    "month": 2,
    "day": 3,
    "flight_date": 5,
    "airline_id": 7,
    "flight_num": 10,
    "origin": 11,
    "dest": 17,
    "crs_dep_time": 23,
    "dep_time": 24,
    "dep_del15": 27,
    "crs_arr_time": 34,
    "arr_time": 35,
    "arr_delay": 36,
    "arr_del15": 38,
    "cancelled": 41,
}

INTS = ["year", "month", "day", "flight_num", "crs_dep_time", "dep_time", "crs_arr_time", "arr_time"]
DOUBLES = ["dep_del15", "arr_del15", "cancelled"]


def year_paths(prefix: str, first: int, last: int) -> list[str]:
    """One file per year of ``[first, last]``, both included: ``prefix`` + year + ``.csv``."""
    return [f"{prefix}{year}.csv" for year in range(first, last + 1)]


def flights_from_text(
    spark: SparkSession, paths: str | Iterable[str], layout: str = "compact", header: bool = False, drops: Drops | None = None
) -> DataFrame:
    """Read flight files of the layout ``compact``, ``short`` or ``full``; ``header`` drops the first line of each."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines_below_header(spark, paths) if header else spark.read.text(paths)
    if layout == "full":
        return flights_from_full_lines(lines, drops=drops)
    return flights_from_lines(lines, {"compact": COMPACT, "short": SHORT}[layout], drops)


def _lines_below_header(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines but for the first of each file, by a CSV reader whose separator is hardly ever met.

    A line that holds the separator is malformed to that reader, which then hands out the whole line as corrupt.
    """
    reader = spark.read.schema("value string, whole string").option("columnNameOfCorruptRecord", "whole")
    lines = reader.options(header=True, sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(paths)
    return lines.select(F.coalesce("whole", "value").alias("value"))


def flights_from_lines(lines: DataFrame, fields: list[str] = COMPACT, drops: Drops | None = None) -> DataFrame:
    """Split the ``value`` column at its commas, without quoting; lines with too few fields are dropped.

    The filter needs the split and would be pushed below it, splitting every line twice. Exploding the one array keeps
    the filter above, so that each line is split once.
    """
    parts = lines.select(F.explode(F.array(F.split("value", ",", -1))).alias("parts"))
    enough = kept(parts, drops, line_has_all_fields=F.size("parts") >= len(fields))
    return enough.select(*(F.col("parts")[i].alias(name) for i, name in enumerate(fields)))


def flights_from_full_lines(lines: DataFrame, columns: Sequence[str] = COMPACT, drops: Drops | None = None) -> DataFrame:
    """Take ``columns`` of the ``value`` column, quoted CSV of the 55-column layout, where city names may hold commas.

    One pass over a line takes the wanted fields, passes over the others and ends at the cancellation field, which a line
    has to reach; shorter lines are dropped, blank fields are kept. As with the other layouts, an explode of the one array
    keeps the filter above it, so that each line is taken apart once.
    """
    wanted = sorted({*columns, "cancelled"}, key=FULL_POSITIONS.__getitem__)
    fields = wanted_fields(F.col("value"), [FULL_POSITIONS[c] for c in wanted], FULL_POSITIONS["cancelled"])
    parts = lines.select(F.explode(F.array(fields)).alias("parts"))
    enough = kept(parts, drops, line_has_all_fields=F.size("parts") == len(wanted))
    return enough.select(*(unquoted(F.col("parts")[wanted.index(c)]).alias(c) for c in columns))


def parse_flights(raw: DataFrame) -> DataFrame:
    """Typed columns for whatever compact columns ``raw`` has; malformed fields become NULL.

    ``flight_date`` stays text, as some jobs carry it through; ``flight_day`` is the date of year, month and day. The
    short layout has no such columns, and there they are taken from ``flight_date``. ``arr_delay`` is cut at the
    decimal point.
    """
    if "year" not in raw.columns:
        named = F.col("flight_date").try_cast("date")
        parts = {"year": F.year(named), "month": F.month(named), "day": F.dayofmonth(named)}
        raw = raw.withColumns({part: c.cast("string") for part, c in parts.items()})

    def typed(name: str) -> Column:
        if name in INTS:
            return int_or_null(name)
        if name in DOUBLES:
            return double_or_null(name)
        return whole_part(name) if name == "arr_delay" else F.col(name)

    columns = [typed(c).alias(c) for c in COMPACT if c in raw.columns]
    day = day_of(F.col("year"), F.col("month"), F.col("day")).alias("flight_day")
    return raw.select(*columns, day)


def write_flights_table(flights: DataFrame, path: str) -> None:
    """Keep parsed flights as Parquet partitioned by year, so that later jobs read only their years and columns.

    The rebalance evens out file sizes: a year is split over as many tasks as it needs.
    """
    flights.hint("rebalance", "year").write.partitionBy("year").mode("overwrite").parquet(path)


def flights_from_table(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """A table of ``write_flights_table``: all of it, or its years ``[first, last]`` by partition pruning."""
    flights = spark.read.parquet(path)
    return flights if first is None else flights.filter(F.col("year").between(first, last))
