from __future__ import annotations

import hashlib

from llm_cases import DOCUMENTS

from tallywing.llm import fingerprints as f


def jaccard(a: str, b: str) -> float:
    def shingles(text: str) -> set:
        w = text.encode().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    x, y = shingles(a), shingles(b)
    return 1.0 if a == b else len(x & y) / max(1, len(x | y))


def brute(rows: list[tuple]) -> list[tuple]:
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1].encode()))
    out = []
    for i, (d, t) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(t, edited), jaccard(t, after)))
    return sorted(out, key=str)


def check(df) -> None:
    got = sorted(f.fingerprints(df).collect(), key=lambda r: str((r["doc_id"], r["n_chars"], r["edited_sha256"])))
    want = brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
    assert [tuple(r[:3]) for r in got] == [r[:3] for r in want]
    errors = [abs(g["near_edited"] - w[3]) for g, w in zip(got, want, strict=True)]
    errors += [abs(g["near_next"] - w[4]) for g, w in zip(got, want, strict=True)]
    assert sum(errors) / len(errors) < 0.03
    assert max(errors) < 0.25


def test_whole_table(documents):
    check(documents)


def test_odd_rows(odd):
    check(odd)


def test_neighbours_over_wide_gaps(spark):
    ids = [-(1 << 62), -5, 0, 3, 1023, 1024, 1 << 20, (1 << 20) + 1, 1 << 27, 1 << 45, (1 << 62) + 9]
    check(spark.createDataFrame([(i, f"text {i} of some words {i % 7}", "en", "s", 1) for i in ids], DOCUMENTS))


def test_single_row_and_empty_table(spark):
    check(spark.createDataFrame([(4, "only one", "en", "s", 1)], DOCUMENTS))
    assert f.fingerprints(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_equal_texts_and_full_bins(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(n)), "en", "s", 1) for i, n in enumerate([1, 1, 4, 5, 6, 30, 30, 400, 400])]
    got = {r["doc_id"]: r["fingerprint"] for r in f.fingerprints(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got[0] == got[1] and got[5] == got[6] and got[7] == got[8] and got[2] != got[3]
    assert {len(x) for x in got.values()} == {2 * f.BINS}


def test_no_python_in_the_plan(spark, documents):
    plan = f.fingerprints(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
