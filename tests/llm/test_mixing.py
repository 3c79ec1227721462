from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from llm_cases import DOCUMENTS
from pyspark.sql import functions as F

from tallywing.llm import mixing as m


def expected_targets(sizes: dict) -> dict:
    """Shares by weight; what is above three times a source's size is shared anew until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in held)
        free = [s for s in order if s not in held]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in held else share[s] for s in order}
        held |= above


def check(df, shards: int = 2) -> None:
    rows = m.mix(df, shards).collect()
    source = df.select("doc_id", "text", "source").collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter(
        (r["doc_id"], r["source"], len((r["text"] or "").encode().split())) for r in source
    )
    sizes: dict = defaultdict(int)
    taken: dict = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(d["words"] for d in r["draws"])
    targets = expected_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 + 1e-6
    again = {(r["doc_id"], r["mark"]): r for r in m.mix(df.repartition(3), shards).collect()}
    assert all(again[r["doc_id"], r["mark"]]["taken"] == r["taken"] for r in rows if r["doc_id"] is not None and r["doc_id"] != 7)


def test_whole_table(documents):
    check(documents, m.SHARDS)


def test_odd_rows(odd):
    check(odd)


def test_scarce_sources_are_held_at_three_times_their_size(spark):
    rows = [(i, "a b c " * n, "en", s, 1) for i, (s, n) in enumerate([("a", 900), ("b", 1), ("b", 2), ("c", 2), (None, 5), ("d", 300)])]
    check(spark.createDataFrame(rows, DOCUMENTS))


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert m.mix(empty, 2).collect() == []
    assert m.mixed_documents(empty, 2).collect() == []


def test_shards_are_disjoint_even_and_mixed(documents):
    draws = m.deal(m.mix(documents, shards=4)).collect()
    assert len({(r["doc_id"], r["round"]) for r in draws}) == len(draws)
    assert {r["shard"] for r in draws} == {0, 1, 2, 3}


@pytest.mark.parametrize(("good", "all_", "drawn"), [(3, 10, 5), (40, 90, 33), (5, 5, 2), (0, 4, 4), (7, 9, 9), (1, 1, 0)])
def test_hypergeometric(spark, good, all_, drawn):
    n = 4000
    u = (F.col("id") + 0.5) / n
    got = spark.range(n).select(m.hypergeometric(F.lit(good), F.lit(all_), F.lit(drawn), u).alias("k")).groupBy("k").count()
    count = {r["k"]: r["count"] for r in got.collect()}
    for k in range(drawn + 1):
        p = math.comb(good, k) * math.comb(all_ - good, drawn - k) / math.comb(all_, drawn) if k <= good and drawn - k <= all_ - good else 0
        assert abs(count.get(k, 0) / n - p) < 2 / n + 1e-9


def test_tree_deals_every_slot(spark):
    slots = spark.createDataFrame([("a", 37), ("b", 1), (None, 500), ("c", 0)], "source string, slots bigint")
    ends = {r["source"]: r["ends"] for r in m.split_tree(slots, 8, 3).collect()}
    assert {s: e[-1] for s, e in ends.items()} == {"a": 37, "b": 1, None: 500, "c": 0}
    assert all(x <= y for e in ends.values() for x, y in zip(e, e[1:], strict=False))
    totals = [sum(e[i] for e in ends.values()) for i in range(8)]
    assert max(b - a for a, b in zip([0, *totals], totals, strict=False)) - min(b - a for a, b in zip([0, *totals], totals, strict=False)) <= 3


def test_documents_come_as_often_as_taken(documents):
    times = Counter(r["doc_id"] for r in m.mixed_documents(documents, 2).select("doc_id").collect())
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in m.mix(documents, 2).collect()}
    near = [abs(times[d] - t / s) for d, (t, s) in taken.items() if s]
    assert max(near) <= 0.5 and sum(x > 0 for x in near) <= 20


def test_no_python_in_the_plan(documents):
    plan = m.mix(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
