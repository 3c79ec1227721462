"""One query per job, and one per operator that no job shows on its own. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as s
from tallywing.operators.graph import in_degree
from tallywing.operators.ontime import airport_traffic, on_time_ratios, on_time_state, ratios_of_state
from tallywing.operators.ranges import first_rows, rank_by_fewer
from tallywing.operators.topn import best_per_key
from tallywing.operators.trips import connecting_trips, distinct_flights
from tallywing.operators.words import word_counts
from tallywing.plans import aviation, links, ontime_counts, titles
from tallywing.sinks.bucketed import BucketedTable
from tallywing.sinks.keyed import TABLES, merge
from tallywing.sinks.state import STATES
from tallywing.sinks.tsv import tsv_lines
from tallywing.sources.flights import COMPACT, SHORT, flights_from_full_lines, flights_from_lines, parse_flights
from tallywing.sources.links import edges_from_lines
from tallywing.sources.names import names_from_records
from tallywing.sources.records import records
from tallywing.sources.text import delimiters_from_lines, league_from_lines, stop_words_from_lines

Query = Callable[[SparkSession, str], DataFrame]


def title_count(spark: SparkSession, sf: str) -> DataFrame:
    return titles.title_count(s.titles(spark, sf), s.DELIMITERS, s.stop_words(spark))


def title_count_all_words(spark: SparkSession, sf: str) -> DataFrame:
    return word_counts(s.titles(spark, sf), s.DELIMITERS)


def top_titles(spark: SparkSession, sf: str) -> DataFrame:
    return titles.top_titles(s.titles(spark, sf), s.DELIMITERS, s.stop_words(spark))


def top_title_statistics(spark: SparkSession, sf: str) -> DataFrame:
    stats = titles.top_title_statistics(s.titles(spark, sf), s.DELIMITERS, s.stop_words(spark))
    return stats.select("statistic", F.col("value").cast("double").alias("value"))


def orphan_pages(spark: SparkSession, sf: str) -> DataFrame:
    return links.orphan_pages(s.edges(spark, sf))


def top_popular_links(spark: SparkSession, sf: str) -> DataFrame:
    return links.top_popular_links(s.edges(spark, sf))


def popularity_league(spark: SparkSession, sf: str) -> DataFrame:
    return links.popularity_league(s.edges(spark, sf), s.league(spark, sf))


def link_counts(spark: SparkSession, sf: str) -> DataFrame:
    return in_degree(s.edges(spark, sf))


def adjacency_text_link_counts(spark: SparkSession, sf: str) -> DataFrame:
    return in_degree(edges_from_lines(s.adjacency(spark, sf)))


def adjacency_text_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return links.orphan_pages(edges_from_lines(s.adjacency(spark, sf)))


def top_popular_airports(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.top_popular_airports(s.flights(spark, sf), s.airports(spark, sf))


def top_on_time_airlines(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return aviation.top_on_time_airlines(flights, s.carriers(spark, sf))


def top_airport_carriers(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.top_airport_carriers(s.flights(spark, sf))


def top_airport_destinations(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.top_airport_destinations(s.flights(spark, sf))


def top_source_dest_carriers(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.top_source_dest_carriers(s.flights(spark, sf))


def source_dest_flight_delays(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.source_dest_flight_delays(s.flights(spark, sf), grouped=False)


def connecting_flights(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.connecting_flights(s.flights(spark, sf))


def airport_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return aviation.airport_carrier_ontime(flights, s.airports(spark, sf), s.carriers(spark, sf))


def airport_dest_ontime(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.airport_dest_ontime(s.flights(spark, sf), s.airports(spark, sf))


def airport_dest_ontime_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.airport_dest_ontime(s.flights(spark, sf), s.airports(spark, sf), aviation.ARRIVAL)


def source_dest_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return aviation.source_dest_carrier_ontime(flights, s.airports(spark, sf), s.carriers(spark, sf))


def source_dest_schedules(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.source_dest_schedules(s.flights(spark, sf))


def connecting_flights_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.connecting_flights_by_day(s.flights(spark, sf))


def connecting_flights_by_day_salted(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.connecting_flights_by_day(s.flights(spark, sf), salts=4)


def connecting_flights_next_day(spark: SparkSession, sf: str) -> DataFrame:
    """Other settings: one day between the legs, the second lands after noon, no way back."""
    return connecting_trips(s.flights(spark, sf), 1, "arr_time", allow_return=False)


def distinct_flown_flights(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_flights(s.flights(spark, sf))


def count_top_popular_airports(spark: SparkSession, sf: str) -> DataFrame:
    return ontime_counts.top_popular_airports(s.flights(spark, sf), s.airports(spark, sf))


def count_top_on_time_airlines(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return ontime_counts.top_on_time_airlines(flights, s.carriers(spark, sf))


def count_airport_carrier_departures(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return ontime_counts.airport_carrier_departures(flights, s.airports(spark, sf), s.carriers(spark, sf))


def count_airport_dest_departures(spark: SparkSession, sf: str) -> DataFrame:
    return ontime_counts.airport_dest_departures(s.flights(spark, sf), s.airports(spark, sf))


def count_source_dest_carrier_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return ontime_counts.source_dest_carrier_arrivals(flights, s.airports(spark, sf), s.carriers(spark, sf))


def count_source_dest_schedules(spark: SparkSession, sf: str) -> DataFrame:
    flights = s.flights(spark, sf)
    return ontime_counts.source_dest_schedules(flights, s.airports(spark, sf), s.carriers(spark, sf))


def best_carriers_per_airport(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed read: the three best airlines of each airport."""
    ratios = on_time_ratios(s.flights(spark, sf), ["origin", "airline_id"], aviation.DEPARTURE)
    return best_per_key(ratios, ["origin"], [F.desc("ontime_percentage"), F.asc("airline_id")], 3)


def year_range_airport_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return airport_traffic(s.flights(spark, sf).filter(F.col("year").between(1996, 1998)))


def compact_text_airline_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Flights written as 16-column text, with blanks for cancelled ones, and read back."""
    lines = s.flight_lines(s.flights(spark, sf), COMPACT)
    return on_time_ratios(parse_flights(flights_from_lines(lines)), ["airline_id"], aviation.ARRIVAL)


def compact_text_connecting_flights(spark: SparkSession, sf: str) -> DataFrame:
    lines = s.flight_lines(s.flights(spark, sf), COMPACT)
    return aviation.connecting_flights_by_day(parse_flights(flights_from_lines(lines)))


def compact_text_connecting_flights_of_any_day(spark: SparkSession, sf: str) -> DataFrame:
    """Text in which some flight numbers and times are blank and delays have decimals."""
    return aviation.connecting_flights(parse_flights(flights_from_lines(s.gappy_lines(s.flights(spark, sf)))))


def full_text_airline_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Flights written as 55-column text, with quoted commas and blank cancellations, and read back."""
    flights = parse_flights(flights_from_full_lines(s.full_lines(s.flights(spark, sf))))
    return on_time_ratios(flights, ["airline_id"], aviation.ARRIVAL)


def source_dest_flight_delays_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted by route and date, which the job writes in that order."""
    return aviation.source_dest_flight_delays(s.flights(spark, sf), grouped=True)


def airport_carrier_ontime_some_names(spark: SparkSession, sf: str) -> DataFrame:
    """Some airports and airlines have no name, some two."""
    return aviation.airport_carrier_ontime(s.flights(spark, sf), s.some_airports(spark, sf), s.some_carriers(spark, sf))


def top_on_time_airlines_some_names(spark: SparkSession, sf: str) -> DataFrame:
    return aviation.top_on_time_airlines(s.flights(spark, sf), s.some_carriers(spark, sf), 50)


def merged_airport_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    """The ratios of flights up to 1996, and merged into them those of all years."""
    flights, names = s.flights(spark, sf), (s.airports(spark, sf), s.carriers(spark, sf))
    old = aviation.airport_carrier_ontime(flights.filter("year <= 1996"), *names)
    table = TABLES["airport_carrier_ontime"]
    return merge(old, aviation.airport_carrier_ontime(flights, *names), table.key, table.order())


def tsv_airline_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """Several values behind the tab."""
    ratios = on_time_ratios(s.flights(spark, sf), ["airline_id"], aviation.ARRIVAL)
    return tsv_lines(ratios, ["airline_id"], ["ontime_count", "total_count"])


def short_text_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Flights written as 9-column text and read back."""
    lines = s.flight_lines(s.flights(spark, sf), SHORT)
    return aviation.top_airport_destinations(flights_from_lines(lines, SHORT))


def tsv_route_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The text a job writes: key fields, tab, values."""
    return tsv_lines(aviation.top_airport_destinations(s.flights(spark, sf)), ["origin", "destination"], ["ontime_count"])


def price_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Rank by a value with about as many distinct values as rows."""
    lines = s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rank_by_fewer(lines, "l_extendedprice")


def first_half_of_words(spark: SparkSession, sf: str) -> DataFrame:
    """A top list as long as half of what it is taken from."""
    counts = word_counts(s.titles(spark, sf), s.DELIMITERS)
    return first_rows(counts, [("occurrences", "desc"), ("word", "desc")], counts.count() // 2)


def airport_names_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Names read from CSV lines, each record broken over two of them."""
    return names_from_records(records(s.name_lines(s.airports(spark, sf), 1)), 1)


def carrier_names_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    return names_from_records(records(s.name_lines(s.carriers(spark, sf), 3)), 3)


def league_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    return links.popularity_league(s.edges(spark, sf), league_from_lines(s.league_lines(spark, sf)))


def title_count_of_listed_stop_words(spark: SparkSession, sf: str) -> DataFrame:
    """The stop words are the texts' language and source names, one a line."""
    documents = s.table(spark, sf, "documents")
    listed = documents.select(F.col("lang").alias("value")).unionAll(documents.select("source")).filter("value is not null")
    return titles.title_count(s.titles(spark, sf), s.DELIMITERS, stop_words_from_lines(listed))


def title_count_of_listed_delimiters(spark: SparkSession, sf: str) -> DataFrame:
    """Every character of the regions' names, in lower case, and the blank are delimiters."""
    lines = s.table(spark, sf, "region").select(F.concat(F.lower("r_name"), F.lit(" ")).alias("value"))
    return titles.title_count(s.titles(spark, sf), delimiters_from_lines(lines))


def airline_ratios_of_states(spark: SparkSession, sf: str) -> DataFrame:
    """Years are counted in two parts, and the counts put together."""
    flights = s.flights(spark, sf)
    parts = [on_time_state(flights.filter(years), ["airline_id"], aviation.ARRIVAL) for years in ("year <= 1995", "year > 1995")]
    return ratios_of_state(parts[0].unionAll(parts[1]), ["airline_id"])


def stored_airline_ratios_of_states(spark: SparkSession, sf: str) -> DataFrame:
    """As above, stored year by year; years up to 1995 twice."""
    flights, root, state = s.flights(spark, sf), s.scratch(spark), STATES["airline_state"]
    for years in ("year <= 1995", "year > 1995", "year <= 1995"):
        state.add(flights.filter(years), root)
    return state.ratios(spark, root)


def _stored(name: str, rows: DataFrame) -> DataFrame:
    """Merged twice into a stored table, the first time without every third row, and read back."""
    table, root = TABLES[name], s.scratch(rows.sparkSession)
    table.upsert(rows.filter(F.pmod(F.xxhash64(*table.key), F.lit(3)) != 0), root)
    table.upsert(rows, root)
    return table.read(rows.sparkSession, root).select(*rows.columns)


def stored_airport_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("airport_carrier_ontime", airport_carrier_ontime(spark, sf))


def stored_airport_dest_ontime(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("airport_dest_ontime", airport_dest_ontime(spark, sf))


def stored_source_dest_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("source_dest_carrier_ontime", source_dest_carrier_ontime(spark, sf))


def stored_connecting_flights(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("connecting_flights", connecting_flights_by_day(spark, sf))


def stored_source_dest_schedules(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("source_dest_schedules", source_dest_schedules(spark, sf))


def stored_airport_carrier_departures(spark: SparkSession, sf: str) -> DataFrame:
    return _stored("airport_carrier_ontime_departures", count_airport_carrier_departures(spark, sf))


def bucketed_airport_carrier_ontime(spark: SparkSession, sf: str) -> DataFrame:
    """Ratios of flights up to 1996 in buckets, and merged into them those of all years."""
    flights, names = s.flights(spark, sf), (s.airports(spark, sf), s.carriers(spark, sf))
    table, root = BucketedTable(TABLES["airport_carrier_ontime"], buckets=8), s.scratch(spark)
    table.upsert(aviation.airport_carrier_ontime(flights.filter("year <= 1996"), *names), root)
    table.upsert(aviation.airport_carrier_ontime(flights, *names), root)
    return table.read(spark, root)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        title_count,
        title_count_all_words,
        top_titles,
        top_title_statistics,
        orphan_pages,
        top_popular_links,
        popularity_league,
        link_counts,
        adjacency_text_link_counts,
        adjacency_text_orphans,
        top_popular_airports,
        top_on_time_airlines,
        top_airport_carriers,
        top_airport_destinations,
        top_source_dest_carriers,
        source_dest_flight_delays,
        connecting_flights,
        airport_carrier_ontime,
        airport_dest_ontime,
        airport_dest_ontime_arrivals,
        source_dest_carrier_ontime,
        source_dest_schedules,
        connecting_flights_by_day,
        connecting_flights_by_day_salted,
        connecting_flights_next_day,
        distinct_flown_flights,
        count_top_popular_airports,
        count_top_on_time_airlines,
        count_airport_carrier_departures,
        count_airport_dest_departures,
        count_source_dest_carrier_arrivals,
        count_source_dest_schedules,
        best_carriers_per_airport,
        year_range_airport_traffic,
        compact_text_airline_ratios,
        compact_text_connecting_flights,
        short_text_route_counts,
        tsv_route_counts,
        compact_text_connecting_flights_of_any_day,
        full_text_airline_ratios,
        source_dest_flight_delays_grouped,
        airport_carrier_ontime_some_names,
        top_on_time_airlines_some_names,
        merged_airport_carrier_ontime,
        tsv_airline_ratios,
        price_rank,
        first_half_of_words,
        airport_names_of_lines,
        carrier_names_of_lines,
        league_of_lines,
        title_count_of_listed_stop_words,
        title_count_of_listed_delimiters,
        airline_ratios_of_states,
        stored_airline_ratios_of_states,
        stored_airport_carrier_ontime,
        stored_airport_dest_ontime,
        stored_source_dest_carrier_ontime,
        stored_connecting_flights,
        stored_source_dest_schedules,
        stored_airport_carrier_departures,
        bucketed_airport_carrier_ontime,
    ]
}
