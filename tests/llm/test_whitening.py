from __future__ import annotations

import math
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywing.llm import whitening as w
from tallywing.llm.queries import QUERIES

SF = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")
SCHEMA = "vec_id bigint, embedding array<float>"


def plain(vectors: list[list[float]], k: int = 8) -> tuple[np.ndarray, np.ndarray, float, list[int]]:
    """Leading eigenpairs by a dense solver, the trace, and the exact deviations."""
    whole = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(whole), [sum(c) for c in zip(*whole, strict=True)]
    x = np.array(whole, dtype=float)
    y = x - x.mean(axis=0)
    e, u = np.linalg.eigh(y.T @ y / n)
    return e[::-1][:k], u[:, ::-1][:, :k], e.sum(), [sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for v in whole]


def check(rows: list, vectors: dict[int, list[float]]) -> None:
    ids = list(vectors)
    e, u, trace, deviations = plain([vectors[i] for i in ids])
    assert len(rows) == len(ids) * len(e)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in vectors[i]] for i in ids], dtype=float)
    y = x - x.mean(axis=0)
    for j in range(len(e)):
        mine = np.array([got[i, j + 1]["whitened"] for i in ids])
        want = y @ u[:, j] / np.sqrt(e[j])
        sign = np.sign(mine @ want)
        assert np.abs(mine * sign - want).max() < 1e-8
        assert all(got[i, j + 1]["explained"] == pytest.approx(e[j] / trace, rel=1e-10) for i in ids)
    for i, d in zip(ids, deviations, strict=True):
        assert {got[i, j + 1]["deviation"] for j in range(len(e))} == {d} and got[i, 1]["n"] == len(ids)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query_against_a_dense_solver(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    check(QUERIES["op12_whitening"](spark, SF).collect(), vectors)


def test_unusable_short_and_repeated_vectors(spark):
    rng = np.random.default_rng(3)
    good = {i: rng.normal(size=5).tolist() for i in range(40)}
    good[40] = good[7]
    short = {41: [0.5, 0.25]}
    bad = [(50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([*good.items(), *short.items(), *bad], SCHEMA).selectExpr("*", "1 as component", "2 as n", "'x' as rows")
    check(w.whiten(frame).collect(), good | {41: [0.5, 0.25, 0.0, 0.0, 0.0]})


def test_no_components(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])], [(1, None)]):
        assert w.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
    one = w.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 4.0])], SCHEMA)).collect()
    assert sorted(round(r["whitened"], 9) for r in one) == [-1.0, 1.0] and {r["component"] for r in one} == {1}
    assert all(r["explained"] == pytest.approx(1.0) for r in one)


def test_large_entries_have_a_defined_result(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]
    got = w.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["deviation"] for r in got if r["vec_id"] == 1} == {None} and all(np.isfinite(r["whitened"]) for r in got)


@pytest.mark.parametrize(
    "values",
    [np.r_[5, 5, 4.999, np.linspace(4, 0.1, 97)], np.r_[1.0, np.zeros(80)], np.ones(90), np.linspace(1, 0.9, 200), np.r_[3.0], np.r_[2.0, 1, 0]],
    ids=["close", "rank one", "all equal", "flat", "one", "three"],
)
def test_eigenpairs_to_rounding(values):
    size, k = len(values), min(8, len(values))
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(size, size)))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    got = w.jacobi_davidson(lambda x: v @ x, size, k)
    assert np.abs(got.values - np.sort(values)[::-1][:k]).max() < 1e-12 * max(values)
    assert np.abs(got.vectors.T @ got.vectors - np.eye(k)).max() < 1e-12
    assert np.abs(v @ got.vectors - got.vectors * got.values).max() < 1e-12 * max(values)
    assert got.products < 400


@given(st.integers(2, 30), st.integers(1, 4), st.integers(0, 1000))
@settings(max_examples=50, deadline=None)
def test_minres_solves_indefinite_systems(size, columns, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(size, size)))
    a = (q * np.where(np.arange(size) % 2, 1.0, -1.0) * (1 + np.arange(size) % 3)) @ q.T
    b = rng.normal(size=(size, columns))
    x = w.minres(lambda v: a @ v, b, 20, 1e-10)
    assert np.abs(a @ x - b).max() < 1e-6


@pytest.mark.parametrize("n", [3, 10**6, 10**13])
def test_deviations_are_exact(n):
    x = np.random.default_rng(n % 97).integers(98000, 102000, size=(20, 6))
    sums = [100000 * n + i for i in range(6)]
    want = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    assert w._deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
