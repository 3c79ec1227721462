"""The splitting tree decides what is taken and how the mix is laid out."""

from __future__ import annotations

from collections import Counter

from llm_cases import DOCUMENTS
from pyspark.sql import functions as F

from tallywing.llm import mixing as m


def test_documents_lie_as_dealt(documents):
    got = m.mixed_documents(documents, 4).withColumn("part", F.spark_partition_id()).select("part", "doc_id").collect()
    dealt = m.mix(documents, 4).select("doc_id", F.explode("draws").alias("d")).filter("d.whole").select("doc_id", "d.*").collect()
    order: dict = {}
    for r in sorted(dealt, key=lambda r: (r["shard"], r["place"], r["doc_id"], r["round"])):
        order.setdefault(r["shard"], []).append(r["doc_id"])
    parts: dict = {}
    for r in got:
        parts.setdefault(r["part"], []).append(r["doc_id"])
    for ids in parts.values():
        rest = list(ids)
        while rest:  # a task holds whole shards, each in its order
            shard = next(s for s in order if rest[: len(order[s])] == order[s])
            rest = rest[len(order.pop(shard)) :]
    assert not order


def test_only_dealt_slots_are_taken(documents, monkeypatch):
    every = m.mix(documents, 4).agg(F.sum("taken")).first()[0]
    tree = m.split_tree
    monkeypatch.setattr(m, "split_tree", lambda *a: tree(*a).select("source", F.slice("ends", 1, 2).alias("ends")))
    half = m.mix(documents, 4)
    assert 0 < half.agg(F.sum("taken")).first()[0] < every
    copies = half.agg(F.sum("copies")).first()[0]
    assert m.mixed_documents(documents, 4).count() == copies


def test_shards_follow_from_slots(spark):
    plan = spark.createDataFrame([(1, 5, 4095), (3, 0, 1023)], "rounds bigint, rest bigint, mask bigint")
    assert m.shards_for(plan) == 256  # 11,264 slots
    assert m.shards_for(plan.limit(0)) == m.SHARDS


def test_texts_without_words_stay(spark):
    rows = [(i, "" if i % 3 else "a b", "en", "s", 1) for i in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    assert Counter(r["doc_id"] for r in m.mixed_documents(docs, 2).collect()) == Counter(range(30))


def test_equal_rows_without_id_are_spread(spark):
    """10,000 equal rows of the null id lie in many blocks, and the mix still takes what its targets say."""
    docs = spark.createDataFrame([(None, "two words", "en", "a", 9)], DOCUMENTS).crossJoin(spark.range(10000)).drop("id")
    other = spark.createDataFrame([(k, "one", "en", "b", 3) for k in range(20)], DOCUMENTS)
    mixed = m.mix(docs.unionByName(other), shards=4)
    rows = mixed.filter("source = 'a'").select("taken", "number").collect()
    assert sorted(r["number"] for r in rows) == list(range(10000))
    assert max(r["taken"] for r in rows) <= 3 * 2
    totals = {r["source"]: (r["x"], r["t"]) for r in mixed.groupBy("source").agg({"taken": "sum", "target": "max"}).toDF("source", "x", "t").collect()}
    assert all(abs(x - t) <= 1 for x, t in totals.values())
