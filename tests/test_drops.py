"""Dropped rows by rule, and CSV records over several lines."""

import json

import pytest
from cases import flight, rows
from pyspark.sql import functions as F

from tallywing.jobs import run
from tallywing.operators.drops import Drops
from tallywing.sources import airport_names, lines_with_places, records

LINES = [
    flight(flight_num=1),
    flight(flight_num=2, cancelled="1.00"),
    flight(flight_num=3, flight_date="2008-1-5"),
    flight(flight_num="x"),
    flight(flight_num=5, crs_arr_time=""),
    flight(flight_num=6, arr_delay=""),
    "too,short",
    "",
]


def test_a_row_counts_for_the_first_rule_it_breaks(spark):
    drops = Drops()
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 != 0, F.col("id")))
    got = drops.keep(drops.keep(df, known=F.col("v").isNotNull(), small=F.col("v") < 50), small=F.col("v") < 40)
    assert got.count() == 36 and drops.counts() == {"known": 10, "small": 54}


SCHEDULES = {
    "line_has_all_fields": 2, "date_has_ten_characters": 1, "date_is_a_number": 0, "flight_number_is_a_number": 1,
    "departure_is_a_number": 0, "arrival_is_a_number": 1,
}
TRIPS = {
    "line_has_all_fields": 2, "not_cancelled": 1, "arr_delay_is_known": 1, "flight_num_is_known": 1, "flight_day_is_known": 0,
    "dep_time_is_known": 0, "arr_time_is_known": 0,
}


@pytest.mark.parametrize(
    "job, want",
    [
        ("source-dest-schedules-table", SCHEDULES),
        ("count-source-dest-schedules-table", SCHEDULES),
        ("connecting-flights-table", TRIPS),
        ("connecting-flights", TRIPS),
        ("top-airport-carriers", {"line_has_all_fields": 2}),
    ],
)
def test_jobs_say_what_they_dropped(spark, write, tmp_path, capsys, job, want):
    lists = ["--airports", write("a.csv", '"A","x"\n'), "--carriers", write("c.csv", '"A","","","x"\n')]
    base = [job, "--input", write("f.csv", "\n".join(LINES) + "\n"), "--output", str(tmp_path / "o"), *lists]
    run(base, spark)
    told = [json.loads(x) for x in capsys.readouterr().err.splitlines() if x.startswith('{"job"')]
    assert told == [{"job": job, "dropped": want}]
    run([*base, "--no-report-drops"], spark)
    assert '{"job"' not in capsys.readouterr().err


def test_league_lines_without_a_number_are_counted(spark, write, tmp_path, capsys):
    base = ["popularity-league", "--input", write("l.txt", "1: 2\n"), "--output", str(tmp_path / "o")]
    run([*base, "--league", write("league.txt", "1\n 2 \nx\n\n")], spark)
    assert '"league_id_is_a_number": 2' in capsys.readouterr().err


@pytest.mark.parametrize("size", [16, 37, 64, 1000])
def test_a_quoted_line_break_at_any_split_reads_right(spark, write, size):
    names = {f"A{i}": f'City {i},\n"{"x" * (i % 9)}"' + "\nend" * (i % 3) for i in range(60)}
    text = "".join('"{}","{}"{}'.format(k, v.replace('"', '""'), "\r\n" if i % 4 else "\n") for i, (k, v) in enumerate(names.items()))
    write("n/a.csv", text.replace("City", "Old"))
    path = write("n/b.csv", text)[: -len("/b.csv")]
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert rows(airport_names(spark, path)) == sorted(names.items())
        lines = lines_with_places(spark, f"{path}/b.csv")
        assert lines.rdd.getNumPartitions() >= (2 if size < 1000 else 1)
        assert records(lines).count() == 60
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_blank_and_missing_names(spark, write):
    path = write("n.csv", '"A",\n"B",""\n"C"\n\n"D","x"\n,"y"\n')
    assert rows(airport_names(spark, path)) == sorted([("A", None), ("B", ""), ("C", None), ("D", "x"), (None, "y")], key=repr)
