"""Jobs over link graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.operators.graph import in_degree, league_rank, orphans
from tallywing.operators.topn import top_n


def orphan_pages(edges: DataFrame) -> DataFrame:
    return orphans(edges)


def top_popular_links(edges: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most linked pages by count and page id, in ascending order."""
    return top_n(in_degree(edges), [F.desc("links"), F.desc("page")], n).orderBy("links", "page")


def popularity_league(edges: DataFrame, league: DataFrame) -> DataFrame:
    return league_rank(edges, league).select("page", "rank")
