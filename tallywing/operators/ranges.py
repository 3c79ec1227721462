"""Places of rows in an order over the whole table, by ranges of values that tasks hold side by side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywing.operators.skew import SLICE, copied, dealt, heavy_keys, sliced

#: Rows that one task may sort for the cut of a top list.
CUT_ROWS = 100_000
#: Ranges at most, as a value is compared with the start of each.
MOST_RANGES = 256


def _range_count(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)


@dataclass(frozen=True)
class Ranges:
    """The first value of each range but the first, and how much lies before each range. One entry per range: the driver
    holds as many as there are shuffle partitions, whatever the number of rows."""

    starts: list[object]
    before: list[int]

    def number(self, value: str) -> Column:
        """The range of a value: how many of the later ranges start at or below it."""
        if not self.starts:
            return F.lit(0)
        return F.size(F.filter(F.array(*map(F.lit, self.starts)), lambda start: start <= F.col(value)))


def ranges_of(frequency: DataFrame, value: str, weight: str) -> Ranges:
    """Ranges of ``value`` (distinct, not NULL) of about equal numbers of rows, with the sums of ``weight`` before each.

    Runs a job. Ranges are described by values, so that a later job means the same ranges, however it is partitioned.
    """
    dealt_out = frequency.repartitionByRange(_range_count(frequency), value).groupBy(F.spark_partition_id().alias("range"))
    found = dealt_out.agg(F.min(value).alias("start"), F.sum(weight).alias("sum")).collect()
    ordered = sorted((r.start, r["sum"]) for r in found)
    before = [0]
    for _, n in ordered[:-1]:
        before.append(before[-1] + n)
    return Ranges([start for start, _ in ordered[1:]], before)


def rank_by_fewer(members: DataFrame, value: str, slice_rows: int = SLICE) -> DataFrame:
    """Add ``rank``: the number of rows with a strictly smaller ``value``. Rows without a value have no rank (NULL).

    Distinct values with their frequencies are divided into ranges; a window adds up frequencies within each range, and
    what lies before a range is known from counting it once. So no task sees all values, and nothing is broadcast that
    grows with them. A value that many members share is joined back in slices.
    """
    valued = members.filter(F.col(value).isNotNull())
    frequency = valued.groupBy(value).agg(F.count("*").alias("members"))
    ranges = ranges_of(frequency, value, "members")
    placed = frequency.withColumn("range", ranges.number(value))
    within = Window.partitionBy("range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.get(F.array(*map(F.lit, ranges.before)), F.col("range"))
    ranks = placed.select(value, "members", (F.coalesce(F.sum("members").over(within), F.lit(0)) + offset).alias("rank"))
    heavy = heavy_keys(frequency, [value], "members", slice_rows)
    left = dealt(sliced(valued, heavy, [value]), members.columns)
    right = copied(sliced(ranks.drop("members"), heavy, [value]))
    ranked = left.join(right, [value, "slice"]).select(*members.columns, "rank")
    return ranked.unionByName(members.filter(F.col(value).isNull()).withColumn("rank", F.lit(None).cast("bigint")))


def _ahead(order: Sequence[tuple[str, str]], row: Sequence[object]) -> Column:
    """Whether a row comes before ``row`` in ``order``, NULL first in ascending and last in descending order."""
    out = F.lit(False)
    for (name, way), value in reversed(list(zip(order, row, strict=True))):
        c, here = F.col(name), F.lit(value)
        if value is None:
            less, more = (F.lit(False), c.isNotNull())
        else:
            less, more = (c.isNull() | (c < here), c > here)
        less, more = (F.coalesce(x, F.lit(False)) for x in (less, more))
        first, after = (less, more) if way == "asc" else (more, less)
        out = first | (~after & out)
    return out


def first_rows(df: DataFrame, order: Sequence[tuple[str, str]], n: int, cut_rows: int = CUT_ROWS) -> DataFrame:
    """The first ``n`` rows by ``order`` (names with ``asc`` or ``desc``, ending in an id), for an ``n`` of any size.

    A limit holds its rows in every task and merges them in one. Here the rows are counted by ranges of the order; the
    range that holds the cut is divided again until it has ``cut_rows`` or cannot be divided. What lies before it is kept
    by a filter, and only the rest of ``n`` is taken from it by a limit. Rows equal in all of the order are alike to it.
    Runs a job or a few, in which the driver gets a row per range.
    """
    columns = [F.asc(c) if way == "asc" else F.desc(c) for c, way in order]
    kept, inside, lower, upper = 0, df, None, None
    while True:
        found = _counted(inside, [c for c, _ in order], columns)
        cut = 0
        while cut < len(found) and kept + found[cut][1] <= n:
            kept += found[cut][1]
            cut += 1
        if cut == len(found):  # all rows up to here are wanted
            return df if upper is None else df.filter(_ahead(order, upper))
        lower = found[cut][0]
        upper = found[cut + 1][0] if cut + 1 < len(found) else upper
        inside = df.filter(~_ahead(order, lower))
        inside = inside if upper is None else inside.filter(_ahead(order, upper))
        if found[cut][1] <= cut_rows or len(found) == 1:
            return df.filter(_ahead(order, lower)).unionAll(inside.orderBy(*columns).limit(n - kept))


def _counted(df: DataFrame, names: list[str], order: list[Column]) -> list[tuple[tuple, int]]:
    """The first row of each range and its number of rows. A range is one sorted task, so ``first`` is its first row."""
    dealt_out = df.select(*names).repartitionByRange(_range_count(df), *order).sortWithinPartitions(*order)
    ranges = dealt_out.groupBy(F.spark_partition_id().alias("range"))
    found = ranges.agg(F.first(F.struct(*names)).alias("start"), F.count("*").alias("n")).collect()
    return [(tuple(r["start"]), r["n"]) for r in sorted(found, key=lambda r: r["range"])]
