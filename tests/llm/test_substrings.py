from __future__ import annotations

import random

import pytest
from llm_cases import DOCUMENTS

from tallywing.llm.substrings import covered_windows, remove_repeats


def brute(rows: list[tuple], length: int) -> dict:
    words = [((d if d is not None else -(1 << 63)), (t or "").encode().split()) for d, t in rows]
    least: dict = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            x = tuple(w[i : i + length])
            least[x] = min(least.get(x, d), d)
    out = []
    for (d, w), (given, _) in zip(words, rows, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < d:
                keep[i : i + length] = [False] * length
        kept = b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode()
        out.append((given, len(w), len(w) - sum(keep), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [0, 3, 4096])
@pytest.mark.parametrize(("length", "seed"), [(6, 2), (8, 8), (5, 1)])
def test_matches_every_window(spark, hot, length, seed):
    rng = random.Random(length * 10 + hot)
    passages = [[rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(4, 20))] for _ in range(6)]
    rows = []
    for i in range(60):
        words: list[str] = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("xyz") * rng.randint(1, 4)] * rng.randint(1, 9)
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words)))
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], DOCUMENTS)
    got = sorted(map(tuple, remove_repeats(df, length, seed, hot).collect()), key=str)
    assert got == brute(rows, length)


def test_odd_rows(spark, odd):
    got = sorted(map(tuple, remove_repeats(odd).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in odd.collect()], 50)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_whole_table(documents):
    got = sorted(map(tuple, remove_repeats(documents).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()], 50)


def test_many_equal_rows_under_one_id_are_looked_at_once(spark):
    line = " ".join(f"w{i}" for i in range(120))
    rows = [(None, line, "en", "a", 1)] * 300 + [(1, "x " + line, "en", "a", 1), (2, line, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS).selectExpr("coalesce(doc_id, -9) as doc_id", "text", "xxhash64(text) as mark")
    covered = covered_windows(docs).collect()
    assert {r["doc_id"] for r in covered} == {1, 2} and sum(r["windows"] for r in covered) == 2 * 71
    got = remove_repeats(spark.createDataFrame(rows, DOCUMENTS)).collect()
    assert len(got) == 302 and sorted((r["doc_id"], r["n_removed"]) for r in got if r["doc_id"]) == [(1, 120), (2, 120)]
    assert {r["n_removed"] for r in got if r["doc_id"] is None} == {0}
