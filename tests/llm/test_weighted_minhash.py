from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from llm_cases import DOCUMENTS

from tallywing.llm import weighted_minhash as m
from tallywing.llm.components import components


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def brute(rows: list[tuple], weight: np.ndarray) -> dict:
    """Least id of each class, by all pairs of texts."""
    texts = [(d, t) for d, t in rows if d is not None and t is not None and t.split()]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        rest = texts[i + 1 :]
        if rest:
            j = m.weighted_jaccard(pa.array([texts[i][1]] * len(rest)), pa.array([t for _, t in rest]), weight)
            for k in np.flatnonzero(j + 1e-12 >= 0.8):
                x, y = find(texts[i][0]), find(rest[k][0])
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def check(spark, df) -> None:
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    weight = m.inverse_frequencies(df.filter("doc_id is not null and text is not null"))
    got = [(r["doc_id"], r["class_id"]) for r in m.near_duplicates(df).collect()]
    classes = brute(rows, weight)
    assert sorted(got, key=str) == sorted(((d, classes.get(d)) for d, _ in rows), key=str)


def test_whole_table(spark, documents):
    check(spark, documents)


def test_odd_rows(spark, odd):
    check(spark, odd)


def test_empty_table(spark):
    assert m.near_duplicates(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_group_of_near_copies(spark):
    """Each copy has edits of its own, so that some pairs are alike only by way of others."""
    rng = random.Random(5)
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 400)) for _ in range(300)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(300)] = f"new{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    check(spark, spark.createDataFrame(rows, DOCUMENTS))


def test_large_group_of_texts_at_the_threshold(spark):
    """Hundreds of copies, most of them less alike than the threshold, over several blocks."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(700):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"new{rng.randint(0, 10**9)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    check(spark, spark.createDataFrame(rows, DOCUMENTS))


def test_prefixes_meet_wherever_texts_are_alike(spark):
    """Every pair at the threshold shares an element whose rests allow it; texts with many words of their own meet none."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for k in range(60):
        words = list(base) + [rng.choice("abc") for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"own{rng.randint(0, 10**9)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    weight = np.random.default_rng(0).uniform(1, 5, 1 << m.CLASS_BITS).astype(np.float32)
    places = {}
    for r in m._prefixes(m._elements(df, weight), 0.8).collect():
        places.setdefault(r["element"], []).append(r)
    met = {
        (x["doc_id"], y["doc_id"])
        for group in places.values()
        for x in group
        for y in group
        if min(x["rest"], y["rest"]) * m.ROUNDING >= 0.8 / 1.8 * (x["total"] + y["total"])
    }
    found = 0
    for i in range(60):
        j = m.weighted_jaccard(pa.array([texts[i]] * 60), pa.array(texts), weight)
        alike = {(i, k) for k in range(60) if k != i and j[k] + 1e-12 >= 0.8}
        found += len(alike)
        assert alike <= met
    assert 0 < found < len(met) < 60 * 59


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(3)
    agree, likeness = [], []
    for _ in range(60):
        h = rng.integers(1, 1 << 63, 300, dtype=np.uint64)
        a, b = rng.uniform(0.5, 6, 300).astype(np.float32), rng.uniform(0.5, 6, 300).astype(np.float32)
        agree.append(np.mean(m.sample(h, a) == m.sample(h, b)))
        likeness.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agree) - np.mean(likeness)) < 0.03


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
