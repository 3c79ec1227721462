import dataclasses
import glob

import pytest
from cases import rows
from pyspark.sql import functions as F

from tallywing.sinks import TABLES, tsv_lines, write_tsv

RATIOS = "origin string, airline_id string, ontime_percentage double, ontime_count bigint, total_count bigint"


def ratios(spark, *data):
    return spark.createDataFrame([(o, a, on / n, on, n) for o, a, on, n in data], RATIOS)


def test_text_has_keys_tab_values(spark):
    df = spark.createDataFrame([("ORD", "AA", 0.5, 1), ("JFK", None, None, 2)], "o string, a string, p double, n int")
    assert rows(tsv_lines(df, ["o", "a"], ["p", "n"])) == [("JFK \t 2",), ("ORD AA\t0.5 1",)]
    assert rows(tsv_lines(df, ["o"], [])) == [("JFK",), ("ORD",)]


def test_ordered_results_are_written_in_order(spark, tmp_path):
    out = str(tmp_path / "out")
    write_tsv(spark.range(100).orderBy(F.desc("id")), ["id"], [], out)
    text = "".join(open(p).read() for p in sorted(glob.glob(out + "/part-*")))
    assert text.split() == [str(i) for i in range(99, -1, -1)]


def test_upsert_replaces_rows_of_a_key_and_keeps_all_others(spark, tmp_path):
    table, root = TABLES["airport_carrier_ontime"], str(tmp_path)
    table.upsert(ratios(spark, *((f"A{i}", "AA", 1, 2) for i in range(50)), ("A1", "BB", 1, 1)), root)
    table.upsert(ratios(spark, ("A1", "AA", 3, 4), ("A99", "AA", 1, 4)), root)
    want = {(f"A{i}", "AA"): (0.5, 1, 2) for i in range(50)}
    want.update({("A1", "BB"): (1.0, 1, 1), ("A1", "AA"): (0.75, 3, 4), ("A99", "AA"): (0.25, 1, 4)})
    assert {r[:2]: r[2:] for r in rows(table.read(spark, root))} == want


def test_upsert_leaves_untouched_folders_alone(spark, tmp_path):
    table, root = TABLES["connecting_flights"], str(tmp_path)
    schema = "origin string, layover string, destination string, origin_flight_date int, flight_num1 int, flight_num2 int, total_arrival_delay bigint"
    table.upsert(spark.createDataFrame([("A", "B", "C", d, 1, 2, 3) for d in (20080105, 20080210)], schema), root)
    before = set(glob.glob(f"{root}/connecting_flights/folder=200801/*"))
    table.upsert(spark.createDataFrame([("A", "B", "C", 20080211, 1, 2, 3)], schema), root)
    assert set(glob.glob(f"{root}/connecting_flights/folder=200801/*")) == before
    assert rows(table.read(spark, root), "origin_flight_date") == [(20080105,), (20080210,), (20080211,)]
    assert [r.origin_flight_date for r in table.get(spark, root, 20080211).collect()] == [20080211]


def test_rows_of_one_key_come_in_clustering_order_from_one_folder(spark, tmp_path):
    table, root = TABLES["airport_carrier_ontime"], str(tmp_path)
    data = [("A", "AA", 1, 2), ("A", "BB", 2, 2), ("A", "CC", 1, 2), ("B", "AA", 1, 9), ("B", "BB", 0, 9)]
    table.upsert(ratios(spark, *data), root)
    got = table.get(spark, root, "A")
    assert [r.airline_id for r in got.collect()] == ["BB", "AA", "CC"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(folder_of_32" in plan and "EqualNullSafe(origin,A)" in plan
    assert rows(table.best(spark, root, 1), "origin", "airline_id") == [("A", "BB"), ("B", "AA")]


@pytest.mark.parametrize("name", list(TABLES))
def test_keys_hold_the_partition_key_and_no_measure(name):
    table = TABLES[name]
    assert set(table.partition_key) <= set(table.key)
    assert not {"ontime_percentage", "ontime_count"} & set(table.key)


def test_one_row_per_key_whatever_comes(spark, tmp_path):
    table, root = TABLES["airport_carrier_ontime"], str(tmp_path)
    table.upsert(ratios(spark, ("A", "AA", 1, 4), ("A", "AA", 2, 4), (None, "AA", 1, 2), ("A", None, 1, 2)), root)
    assert rows(table.read(spark, root)) == rows(ratios(spark, ("A", "AA", 2, 4), (None, "AA", 1, 2), ("A", None, 1, 2)))
    table.upsert(ratios(spark, ("A", "AA", 1, 9), ("A", "AA", 1, 8), (None, "AA", 2, 2), ("A", None, 2, 2)), root)
    assert rows(table.read(spark, root)) == rows(ratios(spark, ("A", "AA", 1, 8), (None, "AA", 2, 2), ("A", None, 2, 2)))


def test_rows_without_a_date_are_replaced_and_kept(spark, tmp_path):
    table, root = TABLES["connecting_flights"], str(tmp_path)
    schema = "origin string, layover string, destination string, origin_flight_date int, flight_num1 int"
    for n in (1, 2):
        table.upsert(spark.createDataFrame([("A", "B", "C", None, n), ("A", "B", str(n), 20080105, n)], schema), root)
    assert rows(table.read(spark, root), "destination", "origin_flight_date", "flight_num1") == [
        ("1", 20080105, 1), ("2", 20080105, 2), ("C", None, 2),
    ]


def test_a_stored_table_keeps_its_number_of_buckets(spark, tmp_path):
    table, root = TABLES["airport_carrier_ontime"], str(tmp_path)
    dataclasses.replace(table, buckets=5).upsert(ratios(spark, *((f"A{i}", "AA", 1, 2) for i in range(9))), root)
    table.upsert(ratios(spark, ("A3", "AA", 2, 2)), root)
    assert all([r.ontime_count for r in table.get(spark, root, f"A{i}").collect()] == [1 + (i == 3)] for i in range(9))
