"""Two-leg trips: a flight before noon and, some days later, another from where it landed, after noon.

Flights are parsed ones (``sources.parse_flights``): ``arr_delay``, ``flight_num``, ``dep_time`` and ``arr_time`` are
ints, ``flight_day`` is a date.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywing.functions.parsing import yyyymmdd
from tallywing.operators.drops import Drops, kept
from tallywing.operators.skew import SLICE, copied, dealt, heavy_keys, sliced

NOON = 1200


def flown(flights: DataFrame, drops: Drops | None = None) -> DataFrame:
    """Flights neither cancelled nor diverted (which have no arrival delay), and with every number a trip needs."""
    needed = ["arr_delay", "flight_num", "flight_day", "dep_time", "arr_time"]
    rules = {"not_cancelled": F.col("cancelled") == 0} | {f"{c}_is_known": F.col(c).isNotNull() for c in needed}
    return kept(flights, drops, **rules)


def distinct_flights(flights: DataFrame) -> DataFrame:
    """Flights that were flown, one row for all copies with equal route, number, day and times: the least delayed."""
    same = ["origin", "dest", "flight_num", "flight_day", "dep_time", "arr_time"]
    return flown(flights).groupBy(*same).agg(F.min("arr_delay").alias("arr_delay"))


def pack(high: Column, low: Column) -> Column:
    """Two ints as one bigint that sorts like the pair.

    The minimum of a pair is needed per group. Of a bigint, Spark computes it by hashing; of a struct, by sorting.
    """
    lifted = low.cast("bigint") + F.lit(1 << 31)
    return F.shiftleft(high.cast("bigint"), 32).bitwiseOR(lifted)


def unpack_high(packed: str) -> Column:
    return F.shiftright(packed, 32).cast("int")


def unpack_low(packed: str) -> Column:
    return (F.col(packed).bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)).cast("int")


_STEP, _LIFT = Decimal(1 << 32), 1 << 31


def _wide(c: Column) -> Column:
    return (c.cast("bigint") + F.lit(_LIFT)).cast("decimal(12,0)")


def pack_wide(first: Column, second: Column, third: Column) -> Column:
    """Three ints as one decimal of at most 29 digits that sorts like the three; its minimum is found by hashing too."""
    pair = (_wide(first) * F.lit(_STEP) + _wide(second)).cast("decimal(24,0)")
    return (pair * F.lit(_STEP) + _wide(third)).cast("decimal(36,0)")


def unpack_wide(packed: str) -> tuple[Column, Column, Column]:
    """The three ints of ``pack_wide``. Integral division keeps whole numbers exact."""
    parts = [f"{packed} div {1 << 64}", f"({packed} % {1 << 64}) div {1 << 32}", f"{packed} % {1 << 32}"]
    return tuple((F.expr(p).cast("bigint") - F.lit(_LIFT)).cast("int") for p in parts)


def connecting_trips(
    flights: DataFrame,
    gap_days: int = 2,
    second_leg_time: str = "dep_time",
    allow_return: bool = True,
    salts: int | None = None,
    slice_rows: int = SLICE,
    drops: Drops | None = None,
) -> DataFrame:
    """The trip of least total arrival delay per first-leg day, origin, layover and destination.

    The first leg departs before noon; the second has its ``second_leg_time`` after noon, ``gap_days`` later. Ties go
    to the lower flight numbers.

    Delays add up, so the best pair is the best first leg into the layover with the best second leg out of it. Both
    are found before the join, in one scan and one aggregation with map-side combining: a hot route or hub is reduced
    to a row per route and day before anything is joined, and no pair of flights is ever formed that is not a result.
    What is left of a hub on one day is at most one row per other airport and direction. Its trips are counted before they
    are formed, and spread over tasks where they are many (``slice_rows``), at the price of copies of its second legs.
    ``salts`` spreads all layovers alike instead, without counting.
    """
    score = pack(F.col("arr_delay"), F.col("flight_num"))
    best = _best_legs(flown(flights, drops), gap_days, second_leg_time, score)
    return _joined(best, allow_return, salts, slice_rows).select(
        "origin",
        "layover",
        "destination",
        yyyymmdd(F.date_sub("meet_day", gap_days)).alias("origin_flight_date"),
        unpack_low("score1").alias("flight_num1"),
        unpack_low("score2").alias("flight_num2"),
        _total().alias("total_arrival_delay"),
    )


def best_trips_of_any_day(
    flights: DataFrame,
    gap_days: int = 2,
    second_leg_time: str = "dep_time",
    allow_return: bool = True,
    salts: int | None = None,
    slice_rows: int = SLICE,
    drops: Drops | None = None,
) -> DataFrame:
    """As ``connecting_trips``, but the one best trip over all days per origin, layover and destination.

    Ties go to the earlier day, then to lower flight numbers and arrival times.
    """
    # Three numbers decide here, so legs are scored by one wide decimal, whose minimum Spark finds by hashing.
    score = pack_wide(F.col("arr_delay"), F.col("flight_num"), F.col("arr_time"))
    best = _best_legs(flown(flights, drops), gap_days, second_leg_time, score)
    keys = ["origin", "layover", "destination"]
    trips = _joined(best, allow_return, salts, slice_rows).select(*keys, "meet_day", "score1", "score2")
    # The trips of all days are many times the result, so what is kept of each is a few numbers, aggregated by hashing
    # right behind the join. Of one origin, layover and destination there is one trip a day: total delay and day (as
    # days since 1970) name it, and together they are the number to find the least of.
    total = [unpack_wide(s)[0].cast("bigint") for s in ("score1", "score2")]
    ranked = trips.withColumn("rank", _wide(total[0] + total[1]) * F.lit(_STEP) + _wide(F.unix_date("meet_day")))
    chosen = ranked.groupBy(*keys).agg(
        *(F.min_by(c, "rank").alias(c) for c in ("score1", "score2", "meet_day"))
    )
    (delay1, number1, time1), (delay2, number2, time2) = unpack_wide("score1"), unpack_wide("score2")
    return chosen.select(
        *keys,
        yyyymmdd(F.date_sub("meet_day", gap_days)).alias("origin_flight_date"),
        yyyymmdd("meet_day").alias("second_flight_date"),
        number1.alias("flight_num1"),
        number2.alias("flight_num2"),
        time1.alias("arr_time1"),
        time2.alias("arr_time2"),
        delay1.alias("arr_delay1"),
        delay2.alias("arr_delay2"),
        (delay1.cast("bigint") + delay2).alias("total_arrival_delay"),
    )


def _total() -> Column:
    return unpack_high("score1").cast("bigint") + unpack_high("score2")


def _joined(best: DataFrame, allow_return: bool, salts: int | None, slice_rows: int) -> DataFrame:
    """First legs with the second legs they meet. A layover's days are dealt over the tasks, salts or not.

    Without ``salts``, the trips of each layover and day are counted beforehand, as the product of the legs on both sides;
    where they are more than ``slice_rows``, the first legs are cut into slices and the second legs copied to each.
    """
    on = ["layover", "meet_day"]
    if salts is None:
        counts = best.groupBy(*on).agg(F.count_if(F.col("role") == 1).alias("into"), F.count_if(F.col("role") == 2).alias("out"))
        heavy = heavy_keys(counts.withColumn("trips", F.col("into") * F.col("out")), on, "trips", slice_rows)
        first, second = (sliced(_leg(best, role, other), heavy, on) for role, other in ((1, "origin"), (2, "destination")))
    else:
        first, second = (_leg(best, role, other).withColumn("slices", F.lit(salts)) for role, other in ((1, "origin"), (2, "destination")))
    trips = dealt(first, ["origin"]).join(copied(second), [*on, "slice"]).drop("slice")
    return trips if allow_return else trips.filter(F.col("origin") != F.col("destination"))


def _best_legs(flights: DataFrame, gap_days: int, second_leg_time: str, score: Column) -> DataFrame:
    """Leg of least ``score`` per role (1 into the layover, 2 out of it), layover, day of the second leg and other airport.

    A flight may serve in both roles, hence the explode. ``role`` is also given back as an aggregate: a filter on that
    stays above the aggregation, so the two sides of the join share its one shuffle; a filter on the grouping column
    would be pushed to the scan and read the flights twice.
    """

    def leg(role: int, takes: Column, layover: str, other: str, meet_day: Column) -> Column:
        parts = [
            F.lit(role).alias("leg"),
            F.col(layover).alias("layover"),
            F.col(other).alias("other"),
            meet_day.alias("meet_day"),
        ]
        return F.when(takes, F.struct(*parts))

    into = leg(1, F.col("dep_time") < NOON, "dest", "origin", F.date_add("flight_day", gap_days))
    out = leg(2, F.col(second_leg_time) > NOON, "origin", "dest", F.col("flight_day"))
    legs = flights.select(F.explode(F.array(into, out)).alias("l"), score.alias("score")).filter("l is not null")
    keyed = legs.select("l.*", "score").groupBy("leg", "layover", "other", "meet_day")
    return keyed.agg(F.min("score").alias("score"), F.min("leg").alias("role"))


def _leg(best: DataFrame, role: int, other: str) -> DataFrame:
    side = best.filter(F.col("role") == role)
    return side.select("layover", "meet_day", F.col("other").alias(other), F.col("score").alias(f"score{role}"))
