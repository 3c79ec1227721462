"""SQL for DuckDB that must give what ``checks.queries`` gives, stated as plainly as possible (pairs are joined as such)."""

from __future__ import annotations

from checks.standins import DELIMITERS, STOP_WORDS
from tallywing.functions.text import delimiter_class

FLIGHTS = """
flights as (
  select l_suppkey as airline_id,
    cast((l_orderkey * 10 + l_linenumber) % 10000 as integer) as flight_num,
    c_nationkey as origin, s_nationkey as dest,
    cast(l_shipdate as date) as flight_day, cast(cast(l_shipdate as date) as varchar) as flight_date,
    year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as ymd, year(l_shipdate) as year,
    (l_partkey * 37 + l_linenumber * 401) % 2400 as dep_time,
    ((l_partkey * 37 + l_linenumber * 401) % 2400 + 131) % 2400 as arr_time,
    case when not cancelled then cast(l_quantity as bigint) - 20 end as arr_delay,
    case when not cancelled then cast(l_discount > 0.05 as double) end as dep_del15,
    case when not cancelled then cast(l_quantity >= 35 as double) end as arr_del15,
    cancelled
  from (select *, l_returnflag = 'R' and l_linestatus = 'F' as cancelled from lineitem)
  join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey
)"""

EDGES = """
edges as (
  select l_orderkey as src, unnest([l_partkey, l_suppkey]) as dst from lineitem
  union all select o_orderkey, o_orderkey from orders union all select p_partkey, p_partkey from part
)"""

ADJACENCY = """
edges as (
  select l_orderkey as src, unnest([l_orderkey, l_partkey, l_suppkey]) as dst from lineitem
)"""

DEGREE = """
degree as (
  select dst as page, cast(sum(case when src <> dst then 1 else 0 end) as bigint) as links from edges group by dst
)"""

ORPHANS = """
select dst as page from edges group by dst
having sum(case when src <> dst then 1 else 0 end) = 0 and sum(case when src = dst then 1 else 0 end) = 1"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


WORDS = f"""
words as (
  select lower(w) as word from (
    select unnest(regexp_split_to_array(text, {_quoted("[" + delimiter_class(DELIMITERS) + "]+")})) as w from documents
  ) where w <> ''
)"""

STOPPED = f"""
counts as (
  select word, count(*) as occurrences from words
  where word not in ({", ".join(_quoted(w) for w in STOP_WORDS)}) group by word
), top as (select word, occurrences from counts order by occurrences desc, word desc limit 10)"""


def _ratios(keys: str, flag: str) -> str:
    return f"""
ratios as (
  select {keys},
    cast(sum(case when {flag} <= 0 then 1 else 0 end) as double) / cast(count(*) as double) as ontime_percentage,
    cast(sum(case when {flag} <= 0 then 1 else 0 end) as bigint) as ontime_count, count(*) as total_count
  from flights group by {keys}
)"""


def _counts(keys: str, flag: str, name: str = "ontime_count") -> str:
    return f"select {keys}, count(*) as {name} from flights where {flag} <= 0 group by {keys}"


TRAFFIC = """
traffic as (
  select airport, count(*) as flights
  from (select origin as airport from flights union all select dest from flights) group by airport
)"""

ORIGIN_NAME = "left join nation o on o.n_nationkey = origin"
DEST_NAME = "left join nation d on d.n_nationkey = dest"
AIRLINE_NAME = "left join supplier a on a.s_suppkey = airline_id"

SCHEDULES = """
schedules as (
  select * exclude (place) from (
    select airline_id, ymd as flight_date, flight_num, origin, dest, dep_time as depart_time, arr_time as arrival_time,
      row_number() over (partition by airline_id, ymd, flight_num order by dep_time, origin, dest, arr_time) as place
    from flights
  ) where place = 1
)"""


def _trips(gap: int, second: str, back: bool) -> str:
    """Every pair of legs, and its place among those of one key."""
    return f"""
flown as (select * from flights where not cancelled and arr_delay is not null),
pairs as (
  select f.origin, f.dest as layover, g.dest as destination, f.ymd as origin_flight_date, g.ymd as second_flight_date,
    f.flight_num as flight_num1, g.flight_num as flight_num2, f.arr_delay + g.arr_delay as total_arrival_delay,
    f.arr_time as arr_time1, g.arr_time as arr_time2, f.arr_delay as arr_delay1, g.arr_delay as arr_delay2
  from flown f join flown g on f.dest = g.origin and g.flight_day = f.flight_day + {gap}
  where f.dep_time < 1200 and g.{second} > 1200 {"" if back else "and f.origin <> g.dest"}
),
trips as (
  select *, row_number() over (
    partition by origin, layover, destination, origin_flight_date
    order by total_arrival_delay, flight_num1, flight_num2, arr_time1, arr_time2
  ) as place from pairs
)"""


GAPPY_TRIPS = _trips(2, "arr_time", False).replace(
    "and arr_delay is not null",
    "and arr_delay is not null and (dep_time + flight_num) % 11 <> 0 and (dep_time + flight_num) % 13 <> 0"
    " and (dep_time + flight_num) % 17 <> 0",
)

TRIP = "origin, layover, destination, origin_flight_date, flight_num1, flight_num2, total_arrival_delay"
TRIP_OF_DAY = f"select {TRIP} from trips where place = 1"

ORACLE: dict[str, str] = {
    "title_count": f"with {WORDS}, {STOPPED} select word, occurrences from counts",
    "title_count_all_words": f"with {WORDS} select word, count(*) as occurrences from words group by word",
    "top_titles": f"with {WORDS}, {STOPPED} select word, occurrences from top",
    "top_title_statistics": f"""
with {WORDS}, {STOPPED},
basic as (
  select floor(sum(occurrences) / count(*)) as mean, cast(sum(occurrences) as double) as total,
    cast(min(occurrences) as double) as least, cast(max(occurrences) as double) as most
  from top having count(*) > 0
),
spread as (select floor(sum((occurrences - mean) * (occurrences - mean)) / count(*)) as var from top, basic)
select 'Mean' as statistic, cast(mean as double) as value from basic union all select 'Sum', total from basic
union all select 'Min', least from basic union all select 'Max', most from basic
union all select 'Var', cast(var as double) from spread""",
    "orphan_pages": f"with {EDGES} {ORPHANS}",
    "top_popular_links": f"with {EDGES}, {DEGREE} select page, links from degree order by links desc, page desc limit 10",
    "popularity_league": f"""
with {EDGES}, {DEGREE}, members as (select * from degree where page in (select p_partkey from part where p_size = 7))
select page, (select count(*) from members o where o.links < m.links) as rank from members m""",
    "link_counts": f"with {EDGES}, {DEGREE} select page, links from degree",
    "adjacency_text_link_counts": f"with {ADJACENCY}, {DEGREE} select page, links from degree",
    "adjacency_text_orphans": f"with {ADJACENCY} {ORPHANS}",
    "top_popular_airports": f"""
with {FLIGHTS}, {TRAFFIC}
select airport, coalesce(n_name, cast(airport as varchar)) as airport_name, flights
from traffic left join nation on n_nationkey = airport
order by flights desc, airport limit 10""",
    "top_on_time_airlines": f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select airline_id, coalesce(s_name, cast(airline_id as varchar)) as airline_name, ontime_percentage, ontime_count,
  total_count from ratios left join supplier on s_suppkey = airline_id order by ontime_percentage desc, airline_id limit 10""",
    "top_airport_carriers": f"with {FLIGHTS} {_counts('origin, airline_id', 'dep_del15')}",
    "top_airport_destinations": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest", "dep_del15")})
select origin, dest as destination, ontime_count from counts""",
    "top_source_dest_carriers": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest, airline_id", "arr_del15")})
select origin, dest as destination, airline_id, ontime_count from counts""",
    "source_dest_flight_delays": f"with {FLIGHTS} select origin, dest, flight_date, flight_num, arr_del15 from flights",
    "connecting_flights": f"""
with {FLIGHTS}, {_trips(2, "arr_time", False)}
select * exclude (place, place_of_day) from (
  select *, row_number() over (
    partition by origin, layover, destination order by total_arrival_delay, origin_flight_date
  ) as place_of_day from trips where place = 1
) where place_of_day = 1""",
    "airport_carrier_ontime": f"""
with {FLIGHTS}, {_ratios("origin, airline_id", "dep_del15")}
select ratios.*, coalesce(o.n_name, '') as origin_name, coalesce(a.s_name, '') as airline_name
from ratios {ORIGIN_NAME} {AIRLINE_NAME}""",
    "airport_dest_ontime": f"""
with {FLIGHTS}, {_ratios("origin, dest", "dep_del15")}
select origin, dest as destination, ontime_percentage, ontime_count, total_count,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name
from ratios {ORIGIN_NAME} {DEST_NAME}""",
    "airport_dest_ontime_arrivals": f"""
with {FLIGHTS}, {_ratios("origin, dest", "arr_del15")}
select origin, dest as destination, ontime_percentage, ontime_count, total_count,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name
from ratios {ORIGIN_NAME} {DEST_NAME}""",
    "source_dest_carrier_ontime": f"""
with {FLIGHTS}, {_ratios("origin, dest, airline_id", "dep_del15")}
select origin, dest as destination, airline_id, ontime_percentage, ontime_count, total_count,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name,
  coalesce(a.s_name, '') as airline_name
from ratios {ORIGIN_NAME} {DEST_NAME} {AIRLINE_NAME}""",
    "source_dest_schedules": f"""
with {FLIGHTS}, {SCHEDULES}
select airline_id, flight_date, flight_num, origin, dest as destination, depart_time, arrival_time from schedules""",
    "connecting_flights_by_day": f"with {FLIGHTS}, {_trips(2, 'dep_time', True)} {TRIP_OF_DAY}",
    "connecting_flights_by_day_salted": f"with {FLIGHTS}, {_trips(2, 'dep_time', True)} {TRIP_OF_DAY}",
    "connecting_flights_next_day": f"with {FLIGHTS}, {_trips(1, 'arr_time', False)} {TRIP_OF_DAY}",
    "distinct_flown_flights": f"""
with {FLIGHTS}
select origin, dest, flight_num, flight_day, dep_time, arr_time, min(arr_delay) as arr_delay
from flights where not cancelled and arr_delay is not null
group by origin, dest, flight_num, flight_day, dep_time, arr_time""",
    "count_top_popular_airports": f"""
with {FLIGHTS}, {TRAFFIC}
select airport, coalesce(n_name, cast(airport as varchar)) as airport_name, flights
from traffic left join nation on n_nationkey = airport
order by flights desc, airport desc limit 10""",
    "count_top_on_time_airlines": f"""
with {FLIGHTS}, counts as ({_counts("airline_id", "arr_del15")})
select airline_id, coalesce(s_name, cast(airline_id as varchar)) as airline_name, ontime_count
from counts left join supplier on s_suppkey = airline_id
order by ontime_count desc, airline_id desc limit 10""",
    "count_airport_carrier_departures": f"""
with {FLIGHTS}, counts as ({_counts("origin, airline_id", "dep_del15", "ontime_departures")})
select counts.*, coalesce(o.n_name, '') as origin_name, coalesce(a.s_name, '') as airline_name
from counts {ORIGIN_NAME} {AIRLINE_NAME}""",
    "count_airport_dest_departures": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest", "dep_del15", "ontime_departures")})
select origin, dest as destination, ontime_departures,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name
from counts {ORIGIN_NAME} {DEST_NAME}""",
    "count_source_dest_carrier_arrivals": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest, airline_id", "arr_del15", "ontime_arrivals")})
select origin, dest as destination, airline_id, ontime_arrivals,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name,
  coalesce(a.s_name, '') as airline_name
from counts {ORIGIN_NAME} {DEST_NAME} {AIRLINE_NAME}""",
    "count_source_dest_schedules": f"""
with {FLIGHTS}, {SCHEDULES}
select airline_id, flight_date, flight_num, origin, dest as destination, depart_time, arrival_time,
  coalesce(o.n_name, '') as origin_name, coalesce(d.n_name, '') as destination_name,
  coalesce(a.s_name, '') as airline_name
from schedules {ORIGIN_NAME} {DEST_NAME} {AIRLINE_NAME}""",
    "best_carriers_per_airport": f"""
with {FLIGHTS}, {_ratios("origin, airline_id", "dep_del15")}
select * exclude (place) from (
  select *, row_number() over (partition by origin order by ontime_percentage desc, airline_id) as place from ratios
) where place <= 3""",
    "year_range_airport_traffic": f"""
with {FLIGHTS.replace("l_suppkey = s_suppkey", "l_suppkey = s_suppkey where year(l_shipdate) between 1996 and 1998")},
{TRAFFIC} select airport, flights from traffic""",
    "compact_text_airline_ratios": f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select cast(airline_id as varchar) as airline_id, ontime_percentage, ontime_count, total_count from ratios""",
    "compact_text_connecting_flights": f"""
with {FLIGHTS}, {_trips(2, "dep_time", True)}
select cast(origin as varchar) as origin, cast(layover as varchar) as layover,
  cast(destination as varchar) as destination, origin_flight_date, flight_num1, flight_num2, total_arrival_delay
from trips where place = 1""",
    "compact_text_connecting_flights_of_any_day": f"""
with {FLIGHTS}, {GAPPY_TRIPS}
select cast(origin as varchar) as origin, cast(layover as varchar) as layover,
  cast(destination as varchar) as destination, origin_flight_date, second_flight_date, flight_num1, flight_num2,
  arr_time1, arr_time2, arr_delay1, arr_delay2, total_arrival_delay
from (
  select *, row_number() over (
    partition by origin, layover, destination order by total_arrival_delay, origin_flight_date
  ) as place_of_day from trips where place = 1
) where place_of_day = 1""",
    "full_text_airline_ratios": f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select cast(airline_id as varchar) as airline_id, ontime_percentage, ontime_count, total_count from ratios""",
    "source_dest_flight_delays_grouped": f"with {FLIGHTS} select origin, dest, flight_date, flight_num, arr_del15 from flights",
    "airport_carrier_ontime_some_names": f"""
with {FLIGHTS}, {_ratios("origin, airline_id", "dep_del15")}
select ratios.*, coalesce(o.n_name, '') as origin_name, coalesce(a.s_name, '') as airline_name
from ratios left join (select * from nation where n_regionkey <> 2) o on o.n_nationkey = origin
left join (select * from supplier where s_acctbal > 0) a on a.s_suppkey = airline_id""",
    "top_on_time_airlines_some_names": f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select airline_id, coalesce(s_name, cast(airline_id as varchar)) as airline_name, ontime_percentage, ontime_count,
  total_count from ratios left join (select * from supplier where s_acctbal > 0) on s_suppkey = airline_id
order by ontime_percentage desc, airline_id limit 50""",
    "merged_airport_carrier_ontime": f"""
with {FLIGHTS}, {_ratios("origin, airline_id", "dep_del15")}
select ratios.*, coalesce(o.n_name, '') as origin_name, coalesce(a.s_name, '') as airline_name
from ratios {ORIGIN_NAME} {AIRLINE_NAME}""",
    "tsv_airline_ratios": f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select airline_id || chr(9) || ontime_count || ' ' || total_count as value from ratios""",
    "short_text_route_counts": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest", "dep_del15")})
select cast(origin as varchar) as origin, cast(dest as varchar) as destination, ontime_count from counts""",
    "tsv_route_counts": f"""
with {FLIGHTS}, counts as ({_counts("origin, dest", "dep_del15")})
select origin || ' ' || dest || chr(9) || ontime_count as value from counts""",
    "price_rank": """
select l_orderkey, l_linenumber, l_extendedprice, rank() over (order by l_extendedprice) - 1 as rank from lineitem""",
    "first_half_of_words": f"""
with {WORDS}, counts as (select word, count(*) as occurrences from words group by word)
select word, occurrences from (
  select *, row_number() over (order by occurrences desc, word desc) as place, count(*) over () as n from counts
) where place <= n // 2""",
    "airport_names_of_lines": f"""
select cast(n_nationkey as varchar) as id, n_name || ', "the' || chr(10) || n_name || '"' as name from nation""",
    "carrier_names_of_lines": f"""
select cast(s_suppkey as varchar) as id, s_name || ', "the' || chr(10) || s_name || '"' as name from supplier""",
    "title_count_of_listed_stop_words": f"""
with {WORDS} select word, count(*) as occurrences from words
where word not in (select lang from documents where lang is not null union select source from documents where source is not null)
group by word""",
    "title_count_of_listed_delimiters": """
with listed as (select '[ \n' || string_agg(distinct c, '') || ']+' as pattern from (select unnest(regexp_extract_all(lower(r_name), '[a-z]')) as c from region)),
words as (select lower(w) as word from (select unnest(regexp_split_to_array(text, pattern)) as w from documents, listed) where w <> '')
select word, count(*) as occurrences from words group by word""",
}
ORACLE["league_of_lines"] = ORACLE["popularity_league"]
ORACLE["airline_ratios_of_states"] = ORACLE["stored_airline_ratios_of_states"] = f"""
with {FLIGHTS}, {_ratios("airline_id", "arr_del15")}
select airline_id, ontime_percentage, ontime_count, total_count from ratios"""
ORACLE["bucketed_airport_carrier_ontime"] = ORACLE["airport_carrier_ontime"]
ORACLE["stored_airport_carrier_departures"] = ORACLE["count_airport_carrier_departures"]
ORACLE["stored_connecting_flights"] = ORACLE["connecting_flights_by_day"]
for _name in ("airport_carrier_ontime", "airport_dest_ontime", "source_dest_carrier_ontime", "source_dest_schedules"):
    ORACLE[f"stored_{_name}"] = ORACLE[_name]
