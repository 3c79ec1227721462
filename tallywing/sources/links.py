"""Link graphs from adjacency text: ``page: link link ...``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywing.functions.parsing import long_or_null
from tallywing.functions.text import delimiter_class, tokens

# Fixed value: what separates the page ids of a line.
SEPARATORS = ":\r\n\t "


def edges_from_text(spark: SparkSession, path: str) -> DataFrame:
    return edges_from_lines(spark.read.text(path))


def edges_from_lines(lines: DataFrame) -> DataFrame:
    """Edges ``(src, dst)`` of the ``value`` column, one per link, duplicates kept.

    The page itself is exploded along with its links, so every line also gives the self marker ``(page, page)`` that
    keeps pages without links in later counts. Blank lines and ids that are no numbers are dropped.

    The line is taken apart inside the explode, and only its first id outside: over a column of ids, Spark would infer
    filters that take each line apart again.
    """
    first = F.regexp_extract("value", f"[^{delimiter_class(SEPARATORS)}]+", 0)
    pages = lines.select(long_or_null(first).alias("src"), "value")
    pairs = pages.select("src", F.explode(tokens(F.col("value"), SEPARATORS)).alias("id"))
    return pairs.select("src", long_or_null("id").alias("dst")).dropna()
