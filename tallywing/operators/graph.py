"""In-degrees and what follows from them. Edges are ``(src, dst)`` with a self marker ``(page, page)`` per page line."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_degree(edges: DataFrame) -> DataFrame:
    """Links from other pages per page: duplicates count, self-links do not, unlinked pages stay with 0."""
    return edges.groupBy(F.col("dst").alias("page")).agg(F.count_if(F.col("src") != F.col("dst")).alias("links"))


def orphans(edges: DataFrame) -> DataFrame:
    """Pages nobody else links to. A page with two lines, or with a link to itself, is none."""
    counts = edges.groupBy(F.col("dst").alias("page")).agg(
        F.count_if(F.col("src") != F.col("dst")).alias("foreign"),
        F.count_if(F.col("src") == F.col("dst")).alias("own"),
    )
    return counts.filter((F.col("foreign") == 0) & (F.col("own") == 1)).select("page")


def league_rank(edges: DataFrame, league: DataFrame) -> DataFrame:
    """Zero-based rank of each league page: how many members of the league have strictly fewer links.

    The semi join sits above the aggregation and Spark decides its place: a league small enough to broadcast filters
    the edges before they are counted, a larger one meets the counts where they lie, both being keyed by page.
    """
    return rank_by_links(in_degree(edges).join(league.select("page"), "page", "left_semi"))


def rank_by_links(members: DataFrame) -> DataFrame:
    """Add ``rank``: the number of rows with strictly fewer ``links``, which have to be in-degrees.

    A window over all rows would run in one task. Here it runs over distinct values with their frequencies only. For
    in-degrees, whose sum is the number of edges E, there are at most sqrt(2E) + 1 distinct values (under 5 million for
    10^13 edges). That bound allows both the single-task window and the broadcast, which in turn keeps a value that
    most members share (0, 1) from becoming a hot join key. Other values have no such bound: ``ranges.rank_by_fewer``.
    """
    frequency = members.groupBy("links").agg(F.count("*").alias("members"))
    before = Window.orderBy("links").rowsBetween(Window.unboundedPreceding, -1)
    ranks = frequency.select("links", F.coalesce(F.sum("members").over(before), F.lit(0)).alias("rank"))
    return members.join(F.broadcast(ranks), "links").select(*members.columns, "rank")
