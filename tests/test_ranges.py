"""Ranks and top lists by ranges of values, and joins with measured heavy keys."""

import random

import pytest
from cases import flight, rows
from pyspark.sql import functions as F

from tallywing.operators.ranges import first_rows, rank_by_fewer
from tallywing.operators.skew import copied, dealt, heavy_keys, sliced
from tallywing.operators.trips import best_trips_of_any_day, connecting_trips
from tallywing.plans import titles
from tallywing.sources import flights_from_lines, parse_flights


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "date"])
def test_rank_is_the_number_of_smaller_values(spark, kind):
    rng = random.Random(3)
    data = [(i, rng.choice([None, 7, 7, 7, rng.randint(0, 400)])) for i in range(900)]
    value = F.date_add(F.lit("2008-01-01"), F.col("x")) if kind == "date" else F.lpad(F.col("x").cast("string"), 4, "0") if kind == "string" else F.col("x").cast(kind)
    df = spark.createDataFrame(data, "id int, x int").select("id", value.alias("v"), "x")
    got = {r.id: r.rank for r in rank_by_fewer(df, "v", slice_rows=50).collect()}
    known = [x for _, x in data if x is not None]
    assert got == {i: None if x is None else sum(y < x for y in known) for i, x in data}


def test_rank_of_nothing_and_of_one_value(spark):
    empty = spark.createDataFrame([], "id int, v int")
    assert rank_by_fewer(empty, "v").collect() == []
    assert rows(rank_by_fewer(spark.createDataFrame([(1, 5), (2, 5), (3, None)], "id int, v int"), "v")) == [(1, 5, 0), (2, 5, 0), (3, None, None)]


def test_no_task_ranks_all_values(spark):
    df = rank_by_fewer(spark.range(1000).withColumn("v", F.col("id") % 97), "v")
    assert "SinglePartition" not in plan_of(df)


ORDER = [("a", "desc"), ("b", "asc"), ("id", "asc")]


@pytest.mark.parametrize("cut_rows", [1, 40, 10**6])
@pytest.mark.parametrize("n", [0, 1, 333, 599, 600, 5000])
def test_first_rows_of_any_number(spark, n, cut_rows):
    rng = random.Random(5)
    data = [(rng.choice([None, 1, 2, 2, 3]), rng.choice([None, "x", "y"]), i) for i in range(600)]
    df = spark.createDataFrame(data, "a int, b string, id int").repartition(5)
    nulls_last = sorted(data, key=lambda r: (-(r[0] or -1), r[1] is not None, r[1] or "", r[2]))
    got = first_rows(df, ORDER, n, cut_rows)
    assert rows(got) == sorted(nulls_last[:n], key=repr)


def test_first_rows_of_equal_rows_and_of_none(spark):
    df = spark.range(100).select(F.lit(1).alias("a"), F.lit("x").alias("b"), F.lit(2).alias("id"))
    assert first_rows(df, ORDER, 37, cut_rows=5).count() == 37
    assert first_rows(df.limit(0), ORDER, 3).collect() == []


def test_long_top_lists_have_no_limit_over_all(spark, monkeypatch):
    monkeypatch.setattr(titles, "CUT_ROWS", 3)
    lines = spark.createDataFrame([(" ".join(f"w{i}" for i in range(k)),) for k in range(30)], "value string")
    got = [(r.word, r.occurrences) for r in titles.top_titles(lines, " ", n=20).collect()]
    assert got == sorted(((f"w{i}", 29 - i) for i in range(20)), key=lambda x: (x[1], x[0]))


def test_heavy_keys_are_cut_and_copied_and_no_row_is_lost(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).cast("long").alias("k"), "id")
    left = left.unionAll(spark.createDataFrame([(None, 5000)], "k long, id long"))
    right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    heavy = heavy_keys(left.groupBy("k").agg(F.count("*").alias("n")), ["k"], "n", 100)
    assert rows(heavy) == [(1, 7)]
    joined = dealt(sliced(left, heavy, ["k"]), ["id"]).join(copied(sliced(right, heavy, ["k"])), ["k", "slice"])
    assert rows(joined.select("k", "id", "w")) == rows(left.join(right, "k").select("k", "id", "w"))
    assert joined.filter("k = 1").select("slice").distinct().count() == 7


@pytest.fixture
def hub(spark):
    """Flights of which one airport and day has more than half of all trips, among 30 other days."""
    lines = [flight(origin=f"A{i}", dest="HUB", flight_num=i, dep_time=800, arr_delay=i % 5) for i in range(60)]
    lines += [flight(origin="HUB", dest=f"B{i}", flight_num=i, day=7, dep_time=1300, arr_time=1500, arr_delay=i % 3) for i in range(60)]
    for d in range(8, 28):
        lines += [flight(origin=f"A{i}", dest="X", flight_num=i, day=d, dep_time=800, arr_delay=i) for i in range(13)]
        lines += [flight(origin="X", dest=f"B{i}", flight_num=i, day=d + 2, dep_time=1300, arr_time=1500, arr_delay=i) for i in range(13)]
    return parse_flights(flights_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")))


def test_a_hub_is_spread_without_being_told(spark, hub):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for trips in (connecting_trips, best_trips_of_any_day):
            assert rows(trips(hub, slice_rows=20)) == rows(trips(hub, salts=1)) != []
        got = connecting_trips(hub, slice_rows=20).groupBy(F.spark_partition_id().alias("task")).count().collect()
        sizes = sorted(r["count"] for r in got)
        assert len(sizes) == 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        whole = sorted(r["count"] for r in connecting_trips(hub, salts=1).groupBy(F.spark_partition_id().alias("task")).count().collect())
        assert whole[-1] > 2 * sizes[-1]
    finally:
        for k in settings:
            spark.conf.unset(k)
