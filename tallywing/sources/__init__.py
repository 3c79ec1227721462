from tallywing.sources.flights import (
    flights_from_full_lines,
    flights_from_lines,
    flights_from_table,
    flights_from_text,
    parse_flights,
    write_flights_table,
    year_paths,
)
from tallywing.sources.links import edges_from_lines, edges_from_text
from tallywing.sources.names import airport_names, carrier_names, names_from_records
from tallywing.sources.records import lines_with_places, records
from tallywing.sources.text import (
    delimiters_from_lines,
    delimiters_from_text,
    league_from_lines,
    league_from_text,
    lines_from_text,
    stop_words_from_lines,
    stop_words_from_text,
)

__all__ = [
    "airport_names",
    "carrier_names",
    "delimiters_from_lines",
    "delimiters_from_text",
    "edges_from_lines",
    "edges_from_text",
    "flights_from_full_lines",
    "flights_from_lines",
    "flights_from_table",
    "flights_from_text",
    "league_from_lines",
    "league_from_text",
    "lines_from_text",
    "lines_with_places",
    "names_from_records",
    "parse_flights",
    "records",
    "stop_words_from_lines",
    "stop_words_from_text",
    "write_flights_table",
    "year_paths",
]
