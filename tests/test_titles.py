import math
import random
from collections import Counter
from decimal import Decimal

from cases import rows

from tallywing.functions.text import delimiter_class
from tallywing.operators import floor_statistics, word_counts
from tallywing.plans import titles
from tallywing.sources import delimiters_from_text, lines_from_text, stop_words_from_text

DELIMITERS = " ,;-[]^\\\t"


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_runs_and_edges_of_delimiters_give_no_words(spark):
    got = rows(word_counts(lines(spark, ",, The--cat;", "the [dog]^\\cat", "", " , "), DELIMITERS))
    assert got == [("cat", 2), ("dog", 1), ("the", 2)]


def test_stop_words_match_lower_cased_words_exactly(spark):
    stop = spark.createDataFrame([("the",), ("CAT",)], "word string")
    assert rows(word_counts(lines(spark, "THE The cat"), " ", stop)) == [("cat", 1)]


def test_lower_case_comes_after_splitting(spark):
    assert rows(word_counts(lines(spark, "aXbxc"), "X")) == [("a", 1), ("bxc", 1)]


def test_line_feed_is_always_a_delimiter(spark):
    assert rows(word_counts(lines(spark, "a\nb"), " ")) == [("a", 1), ("b", 1)]


def test_every_ascii_delimiter_is_taken_literally(spark):
    marks = [chr(c) for c in range(32, 127) if not chr(c).isalnum()]
    got = rows(word_counts(lines(spark, *(f"left{m}{m}right" for m in marks)), "".join(marks)))
    assert got == [("left", len(marks)), ("right", len(marks))]
    assert delimiter_class("a") == "\\na"


def test_top_titles_settle_ties_by_word_and_ascend(spark):
    text = lines(spark, "a a a b b c c d d e")
    got = [tuple(r) for r in titles.top_titles(text, " ", n=3).collect()]
    assert got == [("c", 2), ("d", 2), ("a", 3)]


def test_top_is_the_head_of_a_full_sort(spark):
    rng = random.Random(5)
    words = [chr(97 + rng.randrange(20)) for _ in range(300)]
    want = sorted(((n, w) for w, n in Counter(words).items()), reverse=True)[:7]
    got = [(r.occurrences, r.word) for r in titles.top_titles(lines(spark, " ".join(words)), " ", n=7).collect()]
    assert got == sorted(want)


def statistics(values):
    mean = sum(values) // len(values)
    var = sum((v - mean) ** 2 for v in values) // len(values)
    return {"Mean": mean, "Sum": sum(values), "Min": min(values), "Max": max(values), "Var": var}


def test_floor_statistics(spark):
    rng = random.Random(1)
    cases = [[7], [1, 2], [3, 3, 3], [10**12 + 1, 3, 10**12], [rng.randrange(10**6) for _ in range(9)]]
    cases += [[rng.randrange(10**13) for _ in range(10)] for _ in range(3)]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values], "n bigint")
        got = [(r.statistic, r.value) for r in floor_statistics(df, "n").collect()]
        assert got == [(k, Decimal(v)) for k, v in statistics(values).items()]
        assert list(dict(got)) == ["Mean", "Sum", "Min", "Max", "Var"]
    assert math.floor(2.5) == 2


def test_no_statistics_of_nothing(spark):
    assert titles.top_title_statistics(lines(spark, " "), " ").collect() == []


def test_lists_from_files(spark, write):
    path = write("titles.txt", "Hello, World\nthe hello\n\n")
    delimiters = delimiters_from_text(spark, write("d.txt", " ,\n"))
    stop = stop_words_from_text(spark, write("s.txt", "the\n"))
    assert delimiters == " ,"
    assert rows(titles.title_count(lines_from_text(spark, path), delimiters, stop)) == [("hello", 2), ("world", 1)]
