from tallywing.operators.graph import in_degree, league_rank, orphans
from tallywing.operators.lookup import with_name
from tallywing.operators.ontime import airport_traffic, on_time_counts, on_time_ratios, on_time_state, ratios_of_state
from tallywing.operators.ranges import first_rows, rank_by_fewer
from tallywing.operators.schedules import flight_delays, schedules
from tallywing.operators.stats import floor_statistics
from tallywing.operators.topn import best_per_key, top_n
from tallywing.operators.trips import best_trips_of_any_day, connecting_trips, distinct_flights
from tallywing.operators.words import word_counts

__all__ = [
    "airport_traffic",
    "best_per_key",
    "best_trips_of_any_day",
    "connecting_trips",
    "distinct_flights",
    "first_rows",
    "flight_delays",
    "floor_statistics",
    "in_degree",
    "league_rank",
    "on_time_counts",
    "on_time_ratios",
    "on_time_state",
    "orphans",
    "rank_by_fewer",
    "ratios_of_state",
    "schedules",
    "top_n",
    "with_name",
    "word_counts",
]
