"""Jobs over titles: word counts, the most frequent words, statistics of those."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywing.operators.ranges import CUT_ROWS, first_rows
from tallywing.operators.stats import floor_statistics
from tallywing.operators.topn import top_n
from tallywing.operators.words import word_counts


def title_count(lines: DataFrame, delimiters: str, stop_words: DataFrame | None = None) -> DataFrame:
    return word_counts(lines, delimiters, stop_words)


def _most_frequent(lines: DataFrame, delimiters: str, stop_words: DataFrame | None, n: int) -> DataFrame:
    counts = word_counts(lines, delimiters, stop_words)
    if n > CUT_ROWS:  # more than one task should hold
        return first_rows(counts, [("occurrences", "desc"), ("word", "desc")], n)
    return top_n(counts, [F.desc("occurrences"), F.desc("word")], n)


def top_titles(lines: DataFrame, delimiters: str, stop_words: DataFrame | None = None, n: int = 10) -> DataFrame:
    """The ``n`` largest by count and word, in ascending order."""
    return _most_frequent(lines, delimiters, stop_words, n).orderBy("occurrences", "word")


def top_title_statistics(
    lines: DataFrame, delimiters: str, stop_words: DataFrame | None = None, n: int = 10
) -> DataFrame:
    """Mean, Sum, Min, Max and Var of the counts of the ``n`` most frequent words."""
    return floor_statistics(_most_frequent(lines, delimiters, stop_words, n), "occurrences")
