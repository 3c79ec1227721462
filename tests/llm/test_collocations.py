from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS

from tallywing.llm import collocations as c

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text: str | None) -> list[list[str]]:
    return [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", (text or "").translate(ASCII))]


def counted(rows: list[tuple]) -> Counter:
    """Occurrences of each run of one to three words by language."""
    out: Counter = Counter()
    for text, lang in rows:
        for w in pieces(text):
            for n in (1, 2, 3):
                out.update((lang or "und" if lang is None else lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return out


def brute(rows: list[tuple], least: int, most: int) -> list[tuple]:
    f = counted(rows)
    total = Counter()
    for (lang, w), k in f.items():
        total[lang] += k * (len(w) == 1)
    covering: dict = {}
    for (lang, v), k in f.items():
        for inner in (v[:2], v[1:]) if len(v) == 3 and k >= least else ():
            covering[lang, inner] = max(k, covering.get((lang, inner), 0))
    found = []
    for (lang, w), a in f.items():
        if len(w) == 1 or a < least:
            continue
        if 100 * covering.get((lang, w), 0) >= 50 * a:
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    out, places = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        places[lang] += 1
        if places[lang] <= most:
            out.append((lang, places[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return out


def texts(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = ["New", "york", "the", "of", "a", "ÄB", "x\x1cy", "city", "re"]
    gaps = [" ", "  ", "\t", ". ", ",", "\n", " - ", "\x0b"]
    return [("".join(rng.choice(words) + rng.choices(gaps, [12, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, ""])) for _ in range(n)]


@pytest.mark.parametrize("block, part", [(c.BLOCK, c.PART), (200, 100), (1, 1000)])
def test_against_counting_everything(spark, block, part):
    rows = texts(block)
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = [tuple(r) for r in c.collocations(frame, least=3, most=25, block=block, part=part).collect()]
    assert sorted(got) == sorted(brute(rows, 3, 25)) and got


def test_odd_rows_and_ties(spark, odd):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    got = sorted(tuple(r) for r in c.collocations(odd, least=2, most=100000).collect())
    assert got == sorted(brute(rows, 2, 100000)) and ("en", "same words here") in {(r[0], r[2]) for r in got}
    assert c.collocations(spark.createDataFrame([], DOCUMENTS)).collect() == []


@given(st.lists(st.text("aB b.\té\n", max_size=30), max_size=6))
@settings(max_examples=100, deadline=None)
def test_words_of_a_block(some):
    block = c.Block(pa.array(some, pa.large_string()), pa.array(["x"] * len(some), pa.string()))
    got = [block.data[i:j].tobytes().decode() for i, j in zip(block.starts, block.ends, strict=True)]
    assert got == [w for t in some for p in pieces(t) for w in p]


def test_equal_fingerprints_and_hashes_of_different_phrases_are_told_apart(monkeypatch):
    rows = [(t, lang or "und") for t, lang in texts(5, 30)]
    block = c.Block(pa.array([t for t, _ in rows], pa.large_string()), pa.array([x for _, x in rows], pa.string()))
    words, hashes = c._hashed(block)
    assert len(np.unique(words)) == len(np.unique(hashes))
    few = block.identities(hashes % np.uint64(3))  # hashes that collide
    assert len(np.unique(few)) == len(np.unique(words)) and len(set(zip(few, words, strict=True))) == len(np.unique(words))
    monkeypatch.setattr(c, "fingerprints", lambda h, at, n, salt: (h[at] + salt) % np.uint64(7))
    want = counted(rows)
    for n in (1, 2, 3):
        got = Counter()
        for count, i in zip(*block.entries(words, hashes, n)[1:], strict=True):
            phrase = tuple(block.data[block.starts[k] : block.ends[k]].tobytes().decode() for k in range(i, i + n))
            got[block.names[block.lang[i]], phrase] += count
        assert got == {k: v for k, v in want.items() if len(k[1]) == n}


def test_prefix_polynomials_agree_across_their_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    at, salt = np.arange(998), np.zeros(998, dtype=np.uint64)
    want = c.fingerprints(hashes, at, 3, salt)
    monkeypatch.setattr(c, "_STEP", 100)
    assert (c.fingerprints(hashes, at, 3, salt) == want).all()
    again = c.fingerprints(np.tile(hashes[5:8], 50), np.arange(0, 148, 3), 3, salt[:50])
    assert set(again.tolist()) == {int(want[5])}


def test_packed_arrays():
    columns = [np.array([1, 1 << 63, 5], dtype=np.uint64), np.array([0, 2, 3]), np.array([9, 8, 7])]
    got = c._unpacked(c._packed(*columns), 3)
    assert all((a == b.astype(np.uint64)).all() for a, b in zip(got, columns, strict=True))


def steps(rows: list[tuple], parts: int, least: int) -> Counter:
    """Counts by language and phrase, from the steps of each block and part, without Spark."""
    half = len(rows) // 2
    some = [c._written([pa.array([t for t, _ in r], pa.large_string())], [pa.array([x for _, x in r], pa.string())]) for r in (rows[:half], rows[half:])]
    written = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([raw], pa.binary())], ["block", "content"]) for i, raw in enumerate(some)]
    entries = pa.Table.from_batches(list(c._entries(parts)(iter(written))))
    wanted = pa.concat_tables([c._frequent(least)(entries.filter(pc.equal(entries["part"], p))) for p in pc.unique(entries["part"]).to_pylist()])
    out: Counter = Counter()
    for i, own in enumerate(written):
        found = c._phrases(pa.Table.from_batches([own]), wanted.filter(pc.equal(wanted["block"], i)))
        for lang, n, phrase, count in zip(*(found[x].to_pylist() for x in ("lang", "words", "phrase", "count")), strict=True):
            out[lang, n, phrase] += count
    return out


@pytest.mark.parametrize("step, parts", [(1, 1), (7, 5), (100, 2), (1 << 18, 3)])
def test_steps_of_any_size_count_the_same(monkeypatch, step, parts):
    monkeypatch.setattr(c, "_STEP", step)
    monkeypatch.setattr(c, "_known", {})
    rows = texts(step, 40)
    want = counted(rows)
    total: Counter = Counter()
    for (lang, w), k in want.items():
        total[lang, 0, None] += k * (len(w) == 1)
    frequent = {(lang, len(w), " ".join(w)): k for (lang, w), k in want.items() if k >= 3}
    assert {k: v for k, v in steps(rows, parts, 3).items() if v >= 3 or not k[1]} == frequent | {k: v for k, v in total.items() if v}


def test_memory_of_a_block_and_a_part():
    rng = np.random.default_rng(3)
    vocabulary = np.array(["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(30000)], dtype=object)
    words = vocabulary[np.minimum(rng.geometric(1 / 3000, c.BLOCK // 6), 29999)]
    some = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    raw = c._written([pa.array(some, pa.large_string())], [pa.array(["en", "de"] * (len(some) // 2) + ["en"] * (len(some) % 2), pa.string())])
    size = sum(map(len, some))
    written = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([raw], pa.binary())], ["block", "content"])
    table = pa.Table.from_batches(list(c._entries(1)(iter([written]))))
    wanted = c._frequent(10)(table)
    for run in (lambda: [None for _ in c._entries(1)(iter([written]))], lambda: c._frequent(10)(table), lambda: c._phrases(pa.Table.from_batches([written]), wanted)):
        tracemalloc.start()  # counts the arrays of numpy, too
        try:
            run()
            assert tracemalloc.get_traced_memory()[1] < 15 * size
        finally:
            tracemalloc.stop()


def test_no_task_ranks_all_phrases_of_a_language(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["en", "de"]), f"a{i} b", rng.randint(10, 12), 20, 20, rng.randint(1, 3)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, a bigint, l bigint, r bigint, score bigint")
    for most in (4, 500):
        got = c.ranked(frame, most)
        want = []
        for lang in ("en", "de"):
            order = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[5], -r[2], r[1].encode()))
            want += [(lang, r[1], i + 1) for i, r in enumerate(order[:most])]
        assert sorted((r["lang"], r["phrase"], r["rank"]) for r in got.collect()) == sorted(want)
    docs = spark.createDataFrame(texts(4), "text string, lang string")
    plan = c.collocations(docs, least=3, most=4)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [line.split("windowspecdefinition(")[1] for line in plan if "windowspecdefinition(" in line]
    assert len(windows) == 2 and windows[0].startswith("lang#") and "slice#" in windows[1]
    joins = [i for i, line in enumerate(plan) if "Join" in line]
    ranks = [i for i, line in enumerate(plan) if "windowspecdefinition(" in line]
    assert joins[0] < ranks[0] < ranks[1] < joins[1]  # language totals join what is left, all other joins come before
