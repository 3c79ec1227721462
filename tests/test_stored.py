"""Tables in buckets, counts by year, and what a lookup reads."""

import dataclasses
import glob
import os

import pytest
from cases import flight, rows
from pyspark.sql import functions as F

from tallywing.jobs import run
from tallywing.operators import on_time_ratios
from tallywing.sinks import STATES, TABLES, BucketedTable, merge
from tallywing.sources import flights_from_text, parse_flights

RATIOS = "origin string, airline_id string, ontime_percentage double, ontime_count bigint, total_count bigint"
KEYED = TABLES["airport_carrier_ontime"]


def ratios(spark, *data):
    return spark.createDataFrame([(o, a, on / n, on, n) for o, a, on, n in data], RATIOS)


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan


def test_buckets_hold_what_a_merge_gives(spark, tmp_path):
    table, root = BucketedTable(KEYED, buckets=4), str(tmp_path)
    old = [(f"A{i % 40}", f"C{i}", i % 3, 3) for i in range(200)] + [(None, "AA", 1, 2), ("A1", None, 1, 2)]
    new = [("A1", "C1", 2, 3), ("A1", "C1", 1, 3), ("Z", "C1", 1, 1), (None, "AA", 2, 2)]
    table.upsert(ratios(spark, *old), root)
    table.upsert(ratios(spark, *new), root)
    assert rows(table.read(spark, root)) == rows(merge(ratios(spark, *old), ratios(spark, *new), KEYED.key, KEYED.order()))
    assert [r.airline_id for r in table.get(spark, root, None).collect()] == ["AA"]
    assert rows(table.best(spark, root, 1).filter("origin = 'Z'"), "airline_id") == [("C1",)]


def test_a_merge_and_a_top_per_key_move_no_stored_row(spark, tmp_path):
    table, root = BucketedTable(KEYED, buckets=4), str(tmp_path)
    table.upsert(ratios(spark, *((f"A{i % 40}", f"C{i}", 1, 3) for i in range(200))), root)
    plan = final_plan(table.merged(table.read(spark, root), ratios(spark, ("A1", "C1", 2, 3))))
    assert plan.count("Exchange ") == 1 and "Bucketed: true" in plan
    stored = plan[plan.index("FileScan parquet") - 400 : plan.index("FileScan parquet")]
    assert "Exchange" not in stored
    assert "Exchange" not in final_plan(table.best(spark, root, 1))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not tell
    try:
        plan = table.get(spark, root, "A1")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 4" in plan


def test_readers_see_the_last_complete_version_only(spark, tmp_path):
    table, root = BucketedTable(KEYED, buckets=2), str(tmp_path)
    with pytest.raises(FileNotFoundError):
        table.read(spark, root)
    for n in range(1, 5):
        table.upsert(ratios(spark, ("A", "AA", n, 9)), root)
    folders = sorted(os.listdir(table.folder(root)))
    assert folders == ["version-000000003", "version-000000004"]
    os.remove(f"{table.folder(root)}/version-000000004/_SUCCESS")  # as if the job had died
    assert rows(table.read(spark, root), "ontime_count") == [(3,)]
    table.upsert(ratios(spark, ("B", "AA", 1, 9)), root)
    assert rows(table.read(spark, root), "origin", "ontime_count") == [("A", 3), ("B", 1)]
    spark.sql(f"drop table {table._table(root, 5)}")  # another session has not seen it yet
    assert rows(table.read(spark, root), "origin") == [("A",), ("B",)]




def test_a_lookup_reads_one_row_group(spark, tmp_path):
    table = dataclasses.replace(KEYED, buckets=1, row_group=64 << 10)
    data = spark.range(60000).select(
        F.sha1(F.col("id").cast("string")).alias("origin"), F.lit("AA").alias("airline_id"), F.rand(1).alias("ontime_percentage"),
        F.col("id").alias("ontime_count"), F.col("id").alias("total_count"),
    )
    table.upsert(data, str(tmp_path))
    wanted = data.filter("ontime_count = 4321").first().origin
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = table.get(spark, str(tmp_path), wanted)
        assert [r.ontime_count for r in got.collect()] == [4321]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    leaves = got._jdf.queryExecution().executedPlan().collectLeaves()
    read = leaves.apply(0).metrics().apply("numOutputRows").value()
    assert 0 < read < 60000 / 5
    import pyarrow.parquet as pq

    (file,) = glob.glob(f"{tmp_path}/{table.name}/*/*.parquet")
    assert pq.ParquetFile(file).metadata.num_row_groups > 5
    assert [r.ontime_count for r in table.get(spark, str(tmp_path), "absent").collect()] == []


def test_years_are_added_without_reading_others(spark, write, tmp_path):
    flights = [flight(year=y, flight_num=i, airline_id=f"A{i % 3}", arr_del15="1.00" if (i + y) % 4 == 0 else "0.00") for y in (2006, 2007, 2008) for i in range(30)]
    every = parse_flights(flights_from_text(spark, write("f.csv", "\n".join(flights))))
    state, root = STATES["airline_state"], str(tmp_path / "s")
    state.add(every.filter("year < 2008"), root)
    before = set(glob.glob(f"{root}/airline_state/year=200[67]/*"))
    state.add(every.filter("year = 2008"), root)
    state.add(every.filter("year = 2008"), root)  # once more changes nothing
    assert set(glob.glob(f"{root}/airline_state/year=200[67]/*")) == before
    assert rows(state.ratios(spark, root)) == rows(on_time_ratios(every, ["airline_id"], "arr_del15"))
    assert rows(state.ratios(spark, root, 2007, 2008)) == rows(on_time_ratios(every.filter("year > 2006"), ["airline_id"], "arr_del15"))


def test_jobs_of_states(spark, write, tmp_path):
    carriers = write("carriers.csv", '"BB","","","Bravo"\n')
    for year, late in ((2007, "1.00"), (2008, "0.00")):
        write(f"f/{year}.csv", flight(year=year, arr_del15=late) + "\n" + flight(year=year, airline_id="BB") + "\n")
        prefix = str(tmp_path / "f") + "/"
        run(["airline-state", "--input", prefix, "--years", str(year), str(year), "--output", str(tmp_path / "s")], spark)
    base = ["top-on-time-airlines-of-state", "--input", str(tmp_path / "s"), "--carriers", carriers]
    run([*base, "--output", str(tmp_path / "o")], spark)
    assert "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / "o/part-*")))) == "Bravo\t1.0 2 2\nAA\t0.5 1 2\n"
    run([*base, "--years", "2008", "2008", "--output", str(tmp_path / "p")], spark)
    assert "AA\t1.0 1 1" in "".join(open(p).read() for p in glob.glob(str(tmp_path / "p/part-*")))
