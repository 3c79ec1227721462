import datetime as dt
import random

import pytest
from cases import flight, rows
from pyspark.sql import functions as F

from tallywing.operators import connecting_trips, distinct_flights
from tallywing.operators.trips import pack, pack_wide, unpack_high, unpack_low, unpack_wide
from tallywing.plans import aviation
from tallywing.sources import flights_from_lines, parse_flights


def flights(spark, *lines):
    return parse_flights(flights_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")))


def leg1(**fields):
    return flight(**{"origin": "A", "dest": "B", "dep_time": 800, "arr_time": 1000, "flight_num": 1, **fields})


def leg2(**fields):
    return flight(**{"origin": "B", "dest": "C", "dep_time": 1300, "arr_time": 1500, "flight_num": 2, "day": 7, **fields})


def test_pairs_of_ints_survive_packing_and_keep_their_order(spark):
    rng = random.Random(2)
    ends = [-(2**31), -1, 0, 1, 2**31 - 1]
    pairs = [(a, b) for a in ends for b in ends]
    pairs += [(rng.randrange(-(2**31), 2**31), rng.randrange(-(2**31), 2**31)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a int, b int").withColumn("p", pack(F.col("a"), F.col("b")))
    got = df.select("a", "b", "p", unpack_high("p"), unpack_low("p")).collect()
    assert all((r[0], r[1]) == (r[3], r[4]) for r in got)
    assert [(r[0], r[1]) for r in sorted(got, key=lambda r: r[2])] == sorted(pairs)


def test_threes_of_ints_survive_packing_and_keep_their_order(spark):
    rng = random.Random(3)
    ends = [-(2**31), -1, 0, 2**31 - 1]
    threes = [(a, b, c) for a in ends for b in ends for c in ends]
    threes += [tuple(rng.randrange(-(2**31), 2**31) for _ in range(3)) for _ in range(200)]
    df = spark.createDataFrame(threes, "a int, b int, c int").withColumn("p", pack_wide(F.col("a"), F.col("b"), F.col("c")))
    got = df.select("a", "b", "c", "p", *unpack_wide("p")).collect()
    assert all(tuple(r[:3]) == tuple(r[4:]) for r in got)
    assert [tuple(r[:3]) for r in sorted(got, key=lambda r: r[3])] == sorted(threes)


def test_a_flight_without_a_number_or_time_is_no_leg_and_hides_none(spark):
    gaps = [{"flight_num": ""}, {"dep_time": ""}, {"arr_time": ""}]
    bad = [leg1(arr_delay="-99.00", **g) for g in gaps] + [leg2(arr_delay="-99.00", **g) for g in gaps]
    want = [("A", "B", "C", 20080105, 1, 2)]
    for trips in (connecting_trips, aviation.connecting_flights):
        columns = ["origin", "layover", "destination", "origin_flight_date", "flight_num1", "flight_num2"]
        assert rows(trips(flights(spark, *bad, leg1(), leg2())), *columns) == want
        assert rows(trips(flights(spark, *bad, leg1())), *columns) == []


def test_totals_beyond_an_int(spark):
    most = 2**31 - 1
    got = flights(spark, leg1(arr_delay=f"{most}.00"), leg2(arr_delay=f"{most}.00"))
    assert rows(aviation.connecting_flights(got), "total_arrival_delay") == [(2 * most,)]
    assert rows(connecting_trips(got), "total_arrival_delay") == [(2 * most,)]


def test_legs_are_two_days_apart(spark):
    seconds = [leg2(day=d, flight_num=d) for d in (5, 6, 7, 8)]
    assert rows(connecting_trips(flights(spark, leg1(), *seconds))) == [("A", "B", "C", 20080105, 1, 7, 0)]
    assert rows(connecting_trips(flights(spark, leg1(), *seconds), 3), "flight_num2") == [(8,)]


@pytest.mark.parametrize(
    "first, second",
    [((2008, 1, 27), (2008, 1, 29)), ((2008, 1, 31), (2008, 2, 2)), ((2008, 2, 27), (2008, 2, 29))]
    + [((2008, 2, 28), (2008, 3, 1)), ((2007, 2, 27), (2007, 3, 1)), ((2008, 12, 30), (2009, 1, 1))],
)
def test_days_run_through_month_and_year_ends(spark, first, second):
    day = dict(zip(("year", "month", "day"), first))
    late = dict(zip(("year", "month", "day"), second))
    got = rows(connecting_trips(flights(spark, leg1(**day), leg2(**late))), "origin_flight_date")
    assert got == [(first[0] * 10000 + first[1] * 100 + first[2],)]


def test_noon_itself_belongs_to_neither_leg(spark):
    first = [leg1(dep_time=t, flight_num=t) for t in (1159, 1200, 1201)]
    second = [leg2(dep_time=t, flight_num=t) for t in (1159, 1200, 1201)]
    assert rows(connecting_trips(flights(spark, *first, *second)), "flight_num1", "flight_num2") == [(1159, 1201)]


def test_cancelled_and_diverted_flights_make_no_trips(spark):
    lost = [leg1(cancelled="1.00"), leg1(arr_delay=""), leg1(cancelled="")]
    assert rows(connecting_trips(flights(spark, *lost, leg2()))) == []


def test_least_total_delay_then_lower_numbers(spark):
    first = [leg1(flight_num=n, arr_delay=d) for n, d in ((5, "3.00"), (4, "-2.90"), (3, "-2.00"))]
    second = [leg2(flight_num=n, arr_delay=d) for n, d in ((9, "1.00"), (8, "1.00"), (7, "20.00"))]
    got = rows(connecting_trips(flights(spark, *first, *second)), "flight_num1", "flight_num2", "total_arrival_delay")
    assert got == [(3, 8, -1)]


def test_way_back_is_a_setting(spark):
    there_and_back = flights(spark, leg1(), leg2(dest="A"))
    assert len(rows(connecting_trips(there_and_back))) == 1
    assert rows(connecting_trips(there_and_back, allow_return=False)) == []


def test_second_leg_may_be_judged_by_its_arrival(spark):
    early = flights(spark, leg1(), leg2(dep_time=1100, arr_time=1230))
    assert rows(connecting_trips(early)) == []
    assert rows(connecting_trips(early, second_leg_time="arr_time"), "flight_num2") == [(2,)]


def test_one_flight_may_serve_as_either_leg(spark):
    both = dict(dep_time=1100, arr_time=1300)
    chain = flights(spark, leg1(**both), leg2(**both), leg2(origin="C", dest="D", day=9, flight_num=3, **both))
    got = rows(connecting_trips(chain, second_leg_time="arr_time"), "flight_num1", "flight_num2")
    assert got == [(1, 2), (2, 3)]


def test_copies_of_a_flight_count_once_with_the_least_delay(spark):
    copies = flights(spark, leg1(arr_delay="5.00"), leg1(arr_delay="2.00"), leg1(arr_delay="2.00"), leg1(arr_delay=""))
    assert rows(distinct_flights(copies), "flight_num", "arr_delay") == [(1, 2)]


def random_flights(seed, n):
    rng = random.Random(seed)
    start = dt.date(2008, 2, 24)
    out = []
    for _ in range(n):
        day = start + dt.timedelta(days=rng.randrange(9))
        time = rng.choice([700, 1100, 1200, 1300, 1900])
        out.append(
            dict(
                origin=rng.choice("ABCD"), dest=rng.choice("ABCD"), flight_num=rng.randrange(1, 9), year=day.year,
                month=day.month, day=day.day, dep_time=time, arr_time=time + 130,
                arr_delay=rng.choice(["-3.00", "0.00", "4.00", ""]), cancelled=rng.choice(["0.00"] * 5 + ["1.00"]),
            )
        )
    return out


def all_pairs(rows_, gap, second, back):
    flown = [r for r in rows_ if r["cancelled"] == "0.00" and r["arr_delay"]]
    for r in flown:
        r["date"] = dt.date(r["year"], r["month"], r["day"])
    for f in flown:
        for g in flown:
            meets = f["dest"] == g["origin"] and g["date"] - f["date"] == dt.timedelta(days=gap)
            if meets and f["dep_time"] < 1200 < g[second] and (back or f["origin"] != g["dest"]):
                delays = int(float(f["arr_delay"])), int(float(g["arr_delay"]))
                yield f, g, delays


@pytest.mark.parametrize("gap, second, back, salts", [(2, "dep_time", True, 1), (2, "dep_time", True, 3), (1, "arr_time", False, 1)])
def test_against_all_pairs(spark, gap, second, back, salts):
    data = random_flights(7, 150)
    best = {}
    for f, g, delays in all_pairs(data, gap, second, back):
        key = (f["origin"], f["dest"], g["dest"], int(f["date"].strftime("%Y%m%d")))
        best[key] = min(best.get(key, (10**9,)), (sum(delays), f["flight_num"], g["flight_num"]))
    want = sorted((*k, v[1], v[2], v[0]) for k, v in best.items())
    got = connecting_trips(flights(spark, *(flight(**r) for r in data)), gap, second, back, salts=salts)
    assert sorted(rows(got)) == want and len(want) > 20


def test_best_of_any_day_against_all_pairs(spark):
    data = random_flights(8, 150)
    best = {}
    for f, g, delays in all_pairs(data, 2, "arr_time", False):
        key = (f["origin"], f["dest"], g["dest"])
        days = [int(x["date"].strftime("%Y%m%d")) for x in (f, g)]
        value = (sum(delays), days[0], f["flight_num"], g["flight_num"], f["arr_time"], g["arr_time"], *delays, days[1])
        best[key] = min(best.get(key, (10**9,)), value)
    want = sorted((*k, v[1], v[8], *v[2:8], v[0]) for k, v in best.items())
    columns = ["origin", "layover", "destination", "origin_flight_date", "second_flight_date", "flight_num1", "flight_num2"]
    columns += ["arr_time1", "arr_time2", "arr_delay1", "arr_delay2", "total_arrival_delay"]
    got = aviation.connecting_flights(flights(spark, *(flight(**r) for r in data)))
    assert sorted(rows(got, *columns)) == want and len(want) > 10
