from cases import flight, rows

from tallywing.sources import (
    airport_names,
    carrier_names,
    flights_from_table,
    flights_from_text,
    parse_flights,
    write_flights_table,
    year_paths,
)


def test_years_are_inclusive(spark, write):
    for year in (2007, 2008, 2009):
        last = write(f"f/{year}.csv", flight(year=year) + "\n")
    prefix = last[: -len("2009.csv")]
    assert year_paths(prefix, 2007, 2008) == [prefix + "2007.csv", prefix + "2008.csv"]
    got = flights_from_text(spark, year_paths(prefix, 2007, 2008))
    assert rows(got, "year") == [("2007",), ("2008",)]


def test_lines_with_too_few_fields_are_dropped_and_longer_ones_kept(spark, write):
    short = ",".join(flight(origin="AAA").split(",")[:15])
    path = write("f.csv", "\n".join([short, flight(origin="BBB"), flight(origin="CCC") + ",x,y", "", "junk"]) + "\n")
    assert rows(flights_from_text(spark, path), "origin", "cancelled") == [("BBB", "0.00"), ("CCC", "0.00")]


def test_trailing_blanks_count_as_fields(spark, write):
    path = write("f.csv", flight(arr_del15="", cancelled="") + "\n")
    assert rows(flights_from_text(spark, path), "arr_del15", "cancelled") == [("", "")]


def test_quotes_mean_nothing_in_the_compact_layout(spark, write):
    path = write("f.csv", flight(origin='"ORD"') + "\n")
    assert rows(flights_from_text(spark, path), "origin") == [('"ORD"',)]


def test_header_is_data_unless_told_otherwise(spark, write):
    write("f/a.csv", "h" + ",h" * 15 + "\n" + flight(origin="AAA") + "\n")
    path = write("f/b.csv", "h" + ",h" * 15 + "\n" + flight(origin="BBB") + "\n")
    folder = path[: -len("/b.csv")]
    assert rows(flights_from_text(spark, folder), "origin") == [("AAA",), ("BBB",), ("h",), ("h",)]
    assert rows(flights_from_text(spark, folder, header=True), "origin") == [("AAA",), ("BBB",)]


def test_short_layout_takes_the_day_from_the_date(spark, write):
    path = write("f.csv", "2008-02-29,AA,17,ORD,JFK,900,0.00,1100,\nbad,AA,18,ORD,JFK,900,0.00,1100,1.00\nx,y\n")
    typed = parse_flights(flights_from_text(spark, path, "short"))
    assert rows(typed, "flight_num", "year", "month", "day", "arr_del15") == [
        (17, 2008, 2, 29, None),
        (18, None, None, None, 1.0),
    ]


def test_full_layout_reads_its_sixteen_columns_and_quoted_cities(spark, write):
    cells = [""] * 55
    for at, value in {
        0: "2008", 2: "1", 3: "5", 5: "2008-01-05", 7: "AA", 10: "17", 11: "ORD", 12: '"Chicago, IL"', 17: "JFK",
        23: "900", 24: "905", 27: "0.00", 34: "1100", 35: "1105", 36: "-3.00", 38: "0.00", 41: "0.00",
    }.items():
        cells[at] = value
    path = write("f.csv", ",".join(cells) + "\n" + ",".join(cells[:41]) + "\n")
    got = rows(flights_from_text(spark, path, "full"))
    assert got == [
        ("2008", "1", "5", "2008-01-05", "AA", "17", "ORD", "JFK", "900", "905", "0.00", "1100", "1105", "-3.00")
        + ("0.00", "0.00")
    ]


def test_parse_is_tolerant_and_cuts_delays_at_the_point(spark, write):
    lines = [
        flight(flight_num=1, arr_delay="-12.70"),
        flight(flight_num=2, arr_delay="", cancelled="1.00", dep_time="", dep_del15=""),
        flight(flight_num=3, arr_delay="x", day=31, month=2),
        flight(flight_num=4, arr_delay="7"),
    ]
    typed = parse_flights(flights_from_text(spark, write("f.csv", "\n".join(lines))))
    got = [(n, d, t, f, str(day)) for n, d, t, f, day in rows(typed, "flight_num", "arr_delay", "dep_time", "dep_del15", "flight_day")]
    assert got == [
        (1, -12, 900, 0.0, "2008-01-05"),
        (2, None, None, None, "2008-01-05"),
        (3, None, 900, 0.0, "None"),
        (4, 7, 900, 0.0, "2008-01-05"),
    ]


def test_table_of_flights_is_pruned_by_year(spark, write, tmp_path):
    text = write("f.csv", "\n".join(flight(year=y, flight_num=y) for y in (2006, 2007, 2008)))
    write_flights_table(parse_flights(flights_from_text(spark, text)), str(tmp_path / "t"))
    kept = flights_from_table(spark, str(tmp_path / "t"), 2007, 2008)
    assert rows(kept, "flight_num") == [(2007,), (2008,)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_names_may_hold_commas_and_the_last_of_an_id_counts(spark, write):
    airports = write("a.csv", '"ORD","Chicago, IL: O\'Hare"\n"JFK","old"\n"LAX","He said ""hi"""\n"JFK","new"\n')
    assert rows(airport_names(spark, airports)) == [("JFK", "new"), ("LAX", 'He said "hi"'), ("ORD", "Chicago, IL: O'Hare")]
    carriers = write("c.csv", '"19805","x","y","American","z"\n')
    assert rows(carrier_names(spark, carriers)) == [("19805", "American")]


def test_full_layout_keeps_blank_cancellations_and_drops_short_lines(spark, write):
    def line(cancelled, width=55):
        cells = [""] * width
        cells[0], cells[11], cells[12] = "2008", "ORD", '"a, b, c"'
        if width > 41:
            cells[41] = cancelled
        return ",".join(cells)

    path = write("f.csv", "\n".join(["h" + ",h" * 54, line(""), line("0.00"), line("", 42), line("", 41), ""]) + "\n")
    got = rows(flights_from_text(spark, path, "full", header=True), "origin", "cancelled")
    assert got == [("ORD", ""), ("ORD", ""), ("ORD", "0.00")]


def test_a_line_below_a_header_stays_whole(spark, write):
    path = write("f.csv", "h" + ",h" * 15 + "\n" + flight(origin="A\x01B") + "\n" + flight(origin=" C ") + "\n")
    assert rows(flights_from_text(spark, path, header=True), "origin", "cancelled") == [(" C ", "0.00"), ("A\x01B", "0.00")]


def test_the_last_file_counts_for_names_whatever_its_size(spark, write):
    write("n/a.csv", '"JFK","old"\n' + "".join(f'"X{i}","x"\n' for i in range(2000)))
    path = write("n/b.csv", '"JFK","new"\n')
    assert ("JFK", "new") in rows(airport_names(spark, path[: -len("/b.csv")]))
