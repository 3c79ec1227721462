from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywing.llm import neighbours as n

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, part int"


def brute(rows: list[tuple], k: int) -> dict:
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            near = sorted((-float((v * w).sum()), j) for j, w in good if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def found(frame, k=20, **kw) -> dict:
    out: dict = {}
    for r in sorted(n.nearest(frame, F.col("vec_id") % 20 == 0, k, **kw).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got: dict, want: dict) -> float:
    assert got.keys() == want.keys()
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        known = dict(want[q])
        assert all(abs(known[j] - s) < 1e-12 for j, s in near if j in known)
    return np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / len(want[q]) for q in want])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_the_table(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in table.collect()], 20)
    assert recall(found(table), want) >= 0.9


def test_clusters_need_few_parts_and_copies_tie_by_id(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.1 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[0][1]) for i in range(900)]  # one frequent vector
    frame = spark.createDataFrame([(*r, 0, "s", 1) for r in rows], SCHEMA)
    assert recall(found(frame), brute(rows, 20)) >= 0.95
    x = np.array([v for _, v in rows[:3000]], dtype=np.float64)
    assert n.learn(x, 20, 0.98).probes <= n.PARTS // 2


def test_slices_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(n, "SLICE", 7)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(300)]
    frame = spark.createDataFrame([(*r, 0, "s", 1) for r in rows], SCHEMA)
    assert found(frame, 4, recall=1.0) == brute(rows, 4)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [-1.0, 2.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [9.0, 9.0]), (6, []), (80, [1.0])]
    frame = spark.createDataFrame([(*r, 0, "s", 1) for r in rows + bad], SCHEMA)
    assert found(frame) == brute(rows, 20)


def test_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0, "s", 1)] * 3 + [(7, [1.0, 1.0], 0, "s", 1)], SCHEMA)
    assert found(frame) == {0: [(7, 1.0)]}
    assert n.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_parts_are_balanced():
    x = np.random.default_rng(4).normal(size=(1024, 8))
    part = n.balanced_parts(x, n.neighbour_graph(x, 10), 8, np.random.default_rng(0))
    assert np.bincount(part).tolist() == [128] * 8
