"""What the plans must look like to hold at scale."""

import re

import pytest

from checks import standins
from checks.queries import QUERIES
from tallywing.plans import aviation, links
from tallywing.sinks import TABLES
from tallywing.sources import edges_from_text, flights_from_text, league_from_text, parse_flights

SF = "/root/testdata/sf0.001"


def plan_of(df):
    """The plan before adaptive changes."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    plan = plan_of(df)
    return plan[plan.index("Final Plan") : plan.index("Initial Plan")]


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_no_cross_join_no_global_sort_of_data(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("Python", "Pandas", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        if word != "ObjectHashAggregate" or not name.endswith("names_of_lines"):  # these put lines together to records
            assert word not in plan


@pytest.mark.parametrize(
    "name",
    ["top_titles", "top_title_statistics", "top_popular_links", "top_popular_airports", "top_on_time_airlines"]
    + ["count_top_popular_airports", "count_top_on_time_airlines"],
)
def test_top_lists_keep_their_rows_in_every_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "TakeOrderedAndProject" in plan


def test_trips_scan_and_aggregate_the_flights_once(spark):
    plan = final_plan_of(aviation.connecting_flights_by_day(standins.flights(spark, SF)))
    assert "ReusedExchange" in plan and plan.count("lineitem.parquet") == 1
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 3


def test_trips_of_all_days_are_combined_by_hashing_right_behind_the_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(aviation.connecting_flights(standins.flights(spark, SF)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan
    above_join = plan[: plan.index("SortMergeJoin")]
    assert above_join.count("HashAggregate") == 2 and above_join.count("Exchange") == 1
    assert "partial_min_by" in above_join[above_join.index("Exchange") :]


def test_text_lines_are_split_once(spark, write):
    flights = flights_from_text(spark, write("f.csv", "x\n"))
    plan = plan_of(aviation.top_airport_carriers(flights))
    assert plan.count("split(value") == 1
    edges = edges_from_text(spark, write("l.txt", "1: 2\n"))
    assert plan_of(links.top_popular_links(edges)).count("regexp_extract_all(value") == 1
    assert "SortAggregate" not in plan_of(aviation.connecting_flights_by_day(parse_flights(flights)))


def test_small_league_filters_edges_ahead_of_counting(spark, write):
    edges = edges_from_text(spark, write("l.txt", "1: 2\n"))
    plan = plan_of(links.popularity_league(edges, league_from_text(spark, write("league.txt", "1\n"))))
    first = plan[plan.index("LeftSemi") :]
    assert "partial_count" in plan[: plan.index("LeftSemi")] and "Generate explode" in first


def test_only_columns_in_use_are_read(spark):
    plan = plan_of(QUERIES["top_on_time_airlines"](spark, SF))
    read = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert any("l_suppkey" in r and "l_shipdate" not in r and "l_discount" not in r for r in read)


def test_schedules_are_sorted_once_behind_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        plan = plan_of(QUERIES["source_dest_schedules"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "WindowGroupLimit" not in plan and plan.count("Sort [") == 1


def test_a_merge_reads_the_folders_it_touches_only(spark, tmp_path):
    table, root = TABLES["connecting_flights"], str(tmp_path)
    schema = "origin string, layover string, destination string, origin_flight_date int, flight_num1 int"
    table.upsert(spark.createDataFrame([("A", "B", "C", d, 1) for d in (20080105, 20080210)], schema), root)
    stored = spark.read.parquet(table.path(root))
    plan = plan_of(stored.filter(table._in_folders(table.folder_column(stored), [200802])))
    assert re.search(r"PartitionFilters: \[.*folder#\d+ = 200802", plan)
    table.upsert(spark.createDataFrame([("A", "B", "C", 20080211, 1)], schema), root)
    assert table.read(spark, root).count() == 3


def test_nothing_is_broadcast_by_hint_without_a_bound(spark):
    """With automatic broadcasts off, every join is a sort-merge join but for ranks of in-degrees and heavy keys."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, query in QUERIES.items():
            if name.startswith(("stored", "bucketed")):  # plans of a plain scan, once all is written
                continue
            heavy = 2 if "connecting" in name and not name.endswith("salted") or name == "price_rank" else 0
            count = plan_of(query(spark, SF)).count("BroadcastHashJoin")
            assert count == (1 if name in ("popularity_league", "league_of_lines") else heavy), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prices_are_ranked_without_a_task_for_all(spark):
    plan = plan_of(QUERIES["price_rank"](spark, SF))
    assert "SinglePartition" not in plan and plan.count("Window [") == 1
