from cases import flight, rows

from tallywing.plans import aviation, ontime_counts
from tallywing.sources import flights_from_text, parse_flights


def test_bad_dates_and_numbers_are_dropped(spark, write):
    lines = [
        flight(flight_num=1),
        flight(flight_num=2, flight_date=" 2008-01-05 "),
        flight(flight_num=3, flight_date="2008-1-5"),
        flight(flight_num=4, crs_dep_time=""),
        flight(flight_num=5, crs_arr_time="x"),
        flight(flight_num="x"),
        flight(flight_num=6, month="", flight_date="2008-01-05"),
    ]
    typed = parse_flights(flights_from_text(spark, write("f.csv", "\n".join(lines))))
    assert rows(aviation.source_dest_schedules(typed)) == [
        ("AA", 20080105, 1, "ORD", "JFK", 900, 1100),
        ("AA", 20080105, 2, "ORD", "JFK", 900, 1100),
    ]


def test_one_row_per_key_the_first_to_depart(spark, write):
    lines = [flight(origin=o, dest=d, crs_dep_time=t) for o, d, t in (("C", "D", 700), ("B", "D", 600), ("B", "C", 600))]
    lines += [flight(day=6), flight(airline_id="BB")]
    typed = parse_flights(flights_from_text(spark, write("f.csv", "\n".join(lines))))
    assert rows(aviation.source_dest_schedules(typed)) == [
        ("AA", 20080105, 1, "B", "C", 600, 1100),
        ("AA", 20080106, 1, "ORD", "JFK", 900, 1100),
        ("BB", 20080105, 1, "ORD", "JFK", 900, 1100),
    ]
    names = spark.createDataFrame([("B", "Boston"), ("AA", "American")], "id string, name string")
    named = ontime_counts.source_dest_schedules(typed, names, names)
    assert rows(named, "airline_id", "origin_name", "destination_name", "airline_name") == [
        ("AA", "", "", "American"), ("AA", "Boston", "", "American"), ("BB", "", "", ""),
    ]


def test_delays_are_carried_unparsed(spark, write):
    raw = flights_from_text(spark, write("f.csv", flight(arr_del15="") + "\n" + flight(flight_num="7x", arr_del15="q")))
    assert rows(aviation.source_dest_flight_delays(raw)) == [
        ("ORD", "JFK", "2008-01-05", "1", ""), ("ORD", "JFK", "2008-01-05", "7x", "q"),
    ]


def test_delays_may_be_grouped_by_route_and_date(spark, write):
    lines = [flight(origin=o, day=d, flight_num=n) for o, d, n in (("B", 1, 1), ("A", 2, 2), ("B", 1, 3), ("A", 1, 4))]
    raw = flights_from_text(spark, write("f.csv", "\n".join(lines)))
    got = aviation.source_dest_flight_delays(raw, grouped=True).collect()
    assert [r.flight_num for r in got] == ["4", "2", "1", "3"]
