"""All jobs from files to results: ``python -m tallywing JOB --input ... --output ...`` (or via ``run_job.py``).

Jobs with text results write tab-separated lines to ``--output``; jobs with a keyed table merge into it under
``--output``.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallywing import sources
from tallywing.operators.drops import Drops
from tallywing.plans import aviation, links, ontime_counts, titles
from tallywing.session import session
from tallywing.sinks import STATES, TABLES, write_tsv


class Inputs:
    """What the command line names, read when a job asks for it."""

    def __init__(self, spark: SparkSession, options: argparse.Namespace):
        self.spark, self.options = spark, options
        self.drops = Drops() if options.report_drops else None
        self.n: int = options.n

    def _path(self, option: str) -> str:
        value = getattr(self.options, option)
        if value is None:
            raise SystemExit(f"this job needs --{option.replace('_', '-')}")
        return value

    @cached_property
    def lines(self) -> DataFrame:
        return sources.lines_from_text(self.spark, self._path("input"))

    @cached_property
    def edges(self) -> DataFrame:
        return sources.edges_from_text(self.spark, self._path("input"))

    @cached_property
    def raw_flights(self) -> DataFrame:
        """``--input`` is a path, or with ``--years`` what comes before the year in the file names.

        A table holds parsed fields; those are taken as they are.
        """
        o, path = self.options, self._path("input")
        if o.layout == "table":
            return self.flights
        paths = sources.year_paths(path, *o.years) if o.years else path
        return sources.flights_from_text(self.spark, paths, o.layout, o.header, self.drops)

    @cached_property
    def flights(self) -> DataFrame:
        """Typed flights: parsed text, or those of a Parquet table (``--layout table``)."""
        o = self.options
        if o.layout == "table":
            return sources.flights_from_table(self.spark, self._path("input"), *(o.years or ()))
        return sources.parse_flights(self.raw_flights)

    def ratios(self, state: str) -> DataFrame:
        """Ratios of the counts stored under ``--input``, of all years or those of ``--years``."""
        return STATES[state].ratios(self.spark, self._path("input"), *(self.options.years or ()))

    @property
    def delay_flag(self) -> str:
        return {"departure": aviation.DEPARTURE, "arrival": aviation.ARRIVAL}[self.options.delay_flag]

    @property
    def trip(self) -> dict[str, object]:
        """What the command line says about trips; the job's own settings hold for the rest."""
        o = self.options
        said = {"second_leg_time": o.second_leg_time, "allow_return": o.allow_return}
        return {"gap_days": o.gap_days, "salts": o.salts, "drops": self.drops} | {k: v for k, v in said.items() if v is not None}

    @cached_property
    def airports(self) -> DataFrame:
        return sources.airport_names(self.spark, self._path("airports"))

    @cached_property
    def carriers(self) -> DataFrame:
        return sources.carrier_names(self.spark, self._path("carriers"))

    @cached_property
    def delimiters(self) -> str:
        return sources.delimiters_from_text(self.spark, self._path("delimiters"))

    @cached_property
    def stop_words(self) -> DataFrame | None:
        path = self.options.stop_words
        return None if path is None else sources.stop_words_from_text(self.spark, path)

    @cached_property
    def league(self) -> DataFrame:
        return sources.league_from_text(self.spark, self._path("league"), self.drops)


@dataclass(frozen=True)
class Job:
    """``keys`` and ``values`` are the columns left and right of the tab; ``table`` names a keyed table instead.

    ``save`` writes the result in its own way.
    """

    result: Callable[[Inputs], DataFrame]
    keys: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    table: str | None = None
    save: Callable[[DataFrame, str], None] | None = None


RATIO = ("ontime_percentage", "ontime_count", "total_count")

JOBS: dict[str, Job] = {
    "title-count": Job(lambda i: titles.title_count(i.lines, i.delimiters, i.stop_words), ("word",), ("occurrences",)),
    "top-titles": Job(lambda i: titles.top_titles(i.lines, i.delimiters, i.stop_words, i.n), ("word",), ("occurrences",)),
    "top-title-statistics": Job(
        lambda i: titles.top_title_statistics(i.lines, i.delimiters, i.stop_words, i.n), ("statistic",), ("value",)
    ),
    "orphan-pages": Job(lambda i: links.orphan_pages(i.edges), ("page",)),
    "top-popular-links": Job(lambda i: links.top_popular_links(i.edges, i.n), ("page",), ("links",)),
    "popularity-league": Job(lambda i: links.popularity_league(i.edges, i.league), ("page",), ("rank",)),
    "top-popular-airports": Job(
        lambda i: aviation.top_popular_airports(i.flights, i.airports, i.n), ("airport", "airport_name"), ("flights",)
    ),
    "top-on-time-airlines": Job(
        lambda i: aviation.top_on_time_airlines(i.flights, i.carriers, i.n), ("airline_name",), RATIO
    ),
    "top-airport-carriers": Job(
        lambda i: aviation.top_airport_carriers(i.flights), ("origin", "airline_id"), ("ontime_count",)
    ),
    "top-airport-destinations": Job(
        lambda i: aviation.top_airport_destinations(i.flights), ("origin", "destination"), ("ontime_count",)
    ),
    "top-source-dest-carriers": Job(
        lambda i: aviation.top_source_dest_carriers(i.flights),
        ("origin", "destination", "airline_id"),
        ("ontime_count",),
    ),
    "source-dest-flight-delays": Job(
        lambda i: aviation.source_dest_flight_delays(i.raw_flights, i.options.grouped),
        ("origin", "dest", "flight_date"),
        ("flight_num", "arr_del15"),
    ),
    "connecting-flights": Job(
        lambda i: aviation.connecting_flights(i.flights, **i.trip),
        ("origin", "layover", "destination"),
        ("origin_flight_date", "second_flight_date", "flight_num1", "flight_num2")
        + ("arr_time1", "arr_time2", "arr_delay1", "arr_delay2"),
    ),
    "airport-carriers-table": Job(
        lambda i: aviation.airport_carrier_ontime(i.flights, i.airports, i.carriers, i.delay_flag), table="airport_carrier_ontime"
    ),
    "airport-destinations-table": Job(
        lambda i: aviation.airport_dest_ontime(i.flights, i.airports, i.delay_flag), table="airport_dest_ontime"
    ),
    "source-dest-carriers-table": Job(
        lambda i: aviation.source_dest_carrier_ontime(i.flights, i.airports, i.carriers, i.delay_flag),
        table="source_dest_carrier_ontime",
    ),
    "source-dest-schedules-table": Job(
        lambda i: aviation.source_dest_schedules(i.flights, i.drops), table="source_dest_schedules"
    ),
    "connecting-flights-table": Job(
        lambda i: aviation.connecting_flights_by_day(i.flights, **i.trip), table="connecting_flights"
    ),
    "count-top-popular-airports": Job(
        lambda i: ontime_counts.top_popular_airports(i.flights, i.airports, i.n), ("airport_name",), ("flights",)
    ),
    "count-top-on-time-airlines": Job(
        lambda i: ontime_counts.top_on_time_airlines(i.flights, i.carriers, i.n), ("airline_name",), ("ontime_count",)
    ),
    "count-airport-carriers-table": Job(
        lambda i: ontime_counts.airport_carrier_departures(i.flights, i.airports, i.carriers),
        table="airport_carrier_ontime_departures",
    ),
    "count-airport-destinations-table": Job(
        lambda i: ontime_counts.airport_dest_departures(i.flights, i.airports), table="airport_dest_ontime_departures"
    ),
    "count-source-dest-carriers-table": Job(
        lambda i: ontime_counts.source_dest_carrier_arrivals(i.flights, i.airports, i.carriers),
        table="source_dest_carrier_ontime_arrivals",
    ),
    "count-source-dest-schedules-table": Job(
        lambda i: ontime_counts.source_dest_schedules(i.flights, i.airports, i.carriers, i.drops),
        table="named_source_dest_schedules",
    ),
    "airline-state": Job(lambda i: i.flights, save=STATES["airline_state"].add),
    "airport-carrier-state": Job(lambda i: i.flights, save=STATES["airport_carrier_state"].add),
    "airport-dest-state": Job(lambda i: i.flights, save=STATES["airport_dest_state"].add),
    "source-dest-carrier-state": Job(lambda i: i.flights, save=STATES["source_dest_carrier_state"].add),
    "top-on-time-airlines-of-state": Job(
        lambda i: aviation.top_airlines_of(i.ratios("airline_state"), i.carriers, i.n), ("airline_name",), RATIO
    ),
    "flights-table": Job(lambda i: i.flights, save=sources.write_flights_table),
}


def options(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("tallywing", description=__doc__)
    parser.add_argument("job", choices=list(JOBS))
    parser.add_argument("--input", required=True, help="path, or with --years the part of it before the year")
    parser.add_argument("--output", required=True, help="folder for text, or root of the keyed tables")
    parser.add_argument("--years", nargs=2, type=int, metavar=("FIRST", "LAST"))
    parser.add_argument("--layout", choices=["compact", "short", "full", "table"], default="compact")
    parser.add_argument("--header", action="store_true", help="the first line of each flight file is a header")
    parser.add_argument("--airports", help="CSV file of airport names")
    parser.add_argument("--carriers", help="CSV file of carrier names")
    parser.add_argument("--stop-words", help="file of words to leave out")
    parser.add_argument("--delimiters", help="file of characters between words")
    parser.add_argument("--league", help="file of page ids")
    parser.add_argument("--salts", type=int, help="tasks to spread the trips of every layover and day over, instead of measuring which to spread")
    parser.add_argument(
        "--grouped", action=argparse.BooleanOptionalAction, default=True, help="write the delays of one route and date together"
    )
    parser.add_argument("--delay-flag", choices=["departure", "arrival"], default="departure", help="what ratio tables go by")
    parser.add_argument("--gap-days", type=int, default=2, help="days between the legs of a trip")
    parser.add_argument("--second-leg-time", choices=["dep_time", "arr_time"], help="what has to be after noon")
    parser.add_argument("--allow-return", action=argparse.BooleanOptionalAction, help="trips back to the origin")
    parser.add_argument(
        "--report-drops", action=argparse.BooleanOptionalAction, default=True, help="say how many rows each rule dropped"
    )
    parser.add_argument("-n", type=int, default=10, help="how many to keep in top lists")
    return parser.parse_args(args)


#: Spark drops the parts of a plan that turn out to be joined to nothing, and the counts of their rows with them.
EXCLUDED, EMPTY_PARTS = "spark.sql.adaptive.optimizer.excludedRules", "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def run(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    chosen = options(args)
    spark = spark or session(chosen.job)
    said = spark.conf.get(EXCLUDED, None)
    if chosen.report_drops:
        spark.conf.set(EXCLUDED, ",".join(filter(None, [said, EMPTY_PARTS])))
    try:
        inputs = Inputs(spark, chosen)
        _save(JOBS[chosen.job], inputs, chosen.output)
        if inputs.drops is not None:
            print(json.dumps({"job": chosen.job, "dropped": inputs.drops.counts()}), file=sys.stderr)
    finally:
        spark.conf.unset(EXCLUDED) if said is None else spark.conf.set(EXCLUDED, said)


def _save(job: Job, inputs: Inputs, output: str) -> None:
    result = job.result(inputs)
    if job.save:
        job.save(result, output)
    elif job.table:
        TABLES[job.table].upsert(result, output)
    else:
        write_tsv(result, list(job.keys), list(job.values), output)
