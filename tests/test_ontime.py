from cases import flight, rows

from tallywing.operators import airport_traffic, on_time_counts, on_time_ratios, top_n
from tallywing.plans import aviation, ontime_counts
from tallywing.sources import flights_from_text, parse_flights


def flights(spark, write, *lines):
    return flights_from_text(spark, write("f.csv", "\n".join(lines) + "\n"))


def names(spark, **known):
    return spark.createDataFrame(list(known.items()) or [("?", "?")], "id string, name string")


def test_ratio_counts_missing_flags_as_late_and_count_leaves_them_out(spark, write):
    flags = ["0.00", "1.00", "", "junk", "NaN", "-1", "0"]
    raw = flights(spark, write, *(flight(arr_del15=f) for f in flags), flight(airline_id="BB", arr_del15="1.00"))
    for df in (raw, parse_flights(raw)):
        assert rows(on_time_ratios(df, ["airline_id"], "arr_del15")) == [("AA", 3 / 7, 3, 7), ("BB", 0.0, 0, 1)]
        assert rows(on_time_counts(df, ["airline_id"], "arr_del15")) == [("AA", 3)]


def test_blank_airports_are_left_out_of_traffic(spark, write):
    raw = flights(spark, write, flight(), flight(origin=""), flight(origin="JFK", dest="JFK"))
    assert rows(airport_traffic(raw)) == [("JFK", 4), ("ORD", 1)]


def test_traffic_is_twice_the_flights_with_both_ends(spark, write):
    raw = flights(spark, write, *(flight(origin=f"A{i % 7}", dest=f"A{i % 5}") for i in range(40)))
    assert sum(n for _, n in rows(airport_traffic(raw))) == 80


def test_equal_ratios_are_all_kept_in_order_of_id(spark, write):
    raw = flights(
        spark, write, *(flight(airline_id=a, arr_del15=f) for a in ("CC", "AA", "BB") for f in ("0.00", "1.00")),
        flight(airline_id="DD"),
    )
    top = aviation.top_on_time_airlines(raw, names(spark, AA="American"), 3)
    assert [tuple(r) for r in top.collect()] == [
        ("DD", "DD", 1.0, 1, 1), ("AA", "American", 0.5, 1, 2), ("BB", "BB", 0.5, 1, 2),
    ]
    counts = ontime_counts.top_on_time_airlines(raw, names(spark, CC="Century"), 2)
    assert [tuple(r) for r in counts.collect()] == [("CC", "Century", 1), ("DD", "DD", 1)]


def test_equal_counts_at_the_cut(spark, write):
    raw = flights(spark, write, flight(origin="A", dest="B"), flight(origin="C", dest="B"))
    top = aviation.top_popular_airports(raw, names(spark, B="Boston"), 2)
    assert [tuple(r) for r in top.collect()] == [("B", "Boston", 2), ("A", "A", 1)]
    older = ontime_counts.top_popular_airports(raw, names(spark, B="Boston"), 2)
    assert [tuple(r) for r in older.collect()] == [("C", "C", 1), ("B", "Boston", 2)]


def test_text_jobs_count_departures_per_airport_and_arrivals_per_route(spark, write):
    raw = flights(spark, write, flight(dep_del15="0.00", arr_del15="1.00"), flight(dep_del15="", arr_del15="0.00"))
    assert rows(aviation.top_airport_carriers(raw)) == [("ORD", "AA", 1)]
    assert rows(aviation.top_airport_destinations(raw)) == [("ORD", "JFK", 1)]
    assert rows(aviation.top_source_dest_carriers(raw)) == [("ORD", "JFK", "AA", 1)]


def test_tables_hold_ratios_of_departures_and_blank_unknown_names(spark, write):
    raw = flights(spark, write, flight(dep_del15="0.00"), flight(dep_del15="1.00", arr_del15="1.00"))
    airports, carriers = names(spark, ORD="O'Hare"), names(spark, AA="American")
    got = aviation.source_dest_carrier_ontime(raw, airports, carriers)
    assert got.columns == [
        "origin", "destination", "airline_id", "ontime_percentage", "ontime_count", "total_count",
        "origin_name", "destination_name", "airline_name",
    ]
    assert rows(got) == [("ORD", "JFK", "AA", 0.5, 1, 2, "O'Hare", "", "American")]
    assert rows(aviation.airport_dest_ontime(raw, airports)) == [("ORD", "JFK", 0.5, 1, 2, "O'Hare", "")]
    assert rows(aviation.airport_carrier_ontime(raw, airports, carriers)) == [("ORD", "AA", 0.5, 1, 2, "O'Hare", "American")]
    arrivals = ontime_counts.source_dest_carrier_arrivals(raw, airports, carriers)
    assert rows(arrivals) == [("ORD", "JFK", "AA", 1, "O'Hare", "", "American")]


def test_top_n_keeps_fewer_when_there_are_fewer(spark):
    df = spark.range(3)
    assert rows(top_n(df, [df.id.desc()], 10)) == [(0,), (1,), (2,)]
