from __future__ import annotations

import numpy as np
import pyarrow as pa
from llm_cases import DOCUMENTS
from pyspark.sql import functions as F

from tallywing.llm import language, quality

SF = "/root/testdata/sf0.01"


def accuracy(frame, a: str, b: str) -> float:
    return frame.agg(F.avg((F.col(a) == F.col(b)).cast("int"))).first()[0]


def test_languages_of_rows_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = language.fit(docs.filter(~language.held_out("doc_id")))
    out = language.predict(docs, network)
    assert out.count() == docs.count()
    held = out.join(docs.filter("lang is not null"), "doc_id").filter(language.held_out("doc_id"))
    assert accuracy(held, "lang_pred", "lang") >= 0.97
    assert out.filter("score < 0 or score > 1").count() == 0
    again = language.fit(docs.filter(~language.held_out("doc_id")).repartition(3))
    assert all(np.allclose(x, y) for x, y in zip(network.filters, again.filters, strict=True))


def test_language_of_odd_rows(spark, odd):
    network = language.train(*language.cut(*language.buffers(pa.array(["aa bb cc " * 30, "xx yy zz " * 30])))[:1], np.array([0] * 3 + [1] * 3), ["aa", "xx"])
    out = sorted(language.predict(odd, network).collect(), key=str)
    assert len(out) == odd.count()
    assert {r["lang_pred"] for r in out if r["doc_id"] in (1, 2, 5)} == {"und"}
    assert all(r["lang_pred"] in ("aa", "xx") for r in out if r["doc_id"] in (3, 4, 6, 7))
    empty = spark.createDataFrame([], DOCUMENTS)
    assert language.fit(empty) is None
    assert language.predict(empty, network).collect() == []
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}
    digits = spark.createDataFrame([(1, "12 34 !?", "en", "s", 1), (2, "中", "en", "s", 1)], DOCUMENTS)
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in language.predict(digits, network).collect()} == {1: True, 2: False}


def test_all_of_a_text_is_in_its_windows():
    texts = ["x" * n for n in (0, 1, 127, 128, 129, 5000)]
    windows, text, size = language.cut(*language.buffers(pa.array(texts)))
    assert np.bincount(text, size, len(texts)).tolist() == [len(t) for t in texts]
    assert (windows[:, : language.WINDOW] != 0).sum() == sum(map(len, texts))


def test_quality_of_rows_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    network = quality.learnt_from(docs, labels)
    out = quality.scores(docs.select("doc_id", "text"), network)
    assert out.count() == docs.count() and out.filter("score < 0 or score > 1").count() == 0
    held = out.join(labels, "doc_id").filter(quality.held_out("doc_id")).withColumn("p", (F.col("score") >= 0.5).cast("int"))
    assert accuracy(held, "p", "quality") >= 0.97
    assert held.filter("quality = 1 and p = 0").count() <= 1


def test_quality_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(3, 1), (6, 0), (6, 1), (None, 1), (1, None)], "doc_id bigint, quality int")
    network = quality.fit(odd, labels)
    out = quality.scores(odd, network)
    assert sorted(out.columns) == sorted(odd.columns)  # it takes the place of a column of that name
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert scores[1] == scores[2] == scores[5]
    assert scores[3] == scores[4]
    assert quality.fit(odd, labels.limit(0)) is None
    assert {r["score"] for r in quality.scores(odd, None).collect()} == {1.0}
    assert quality.scores(spark.createDataFrame([], DOCUMENTS), network).collect() == []


def test_gradients_of_the_attention_network():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.FEATURES)) for n in (1, 3, 2)]
    net = quality.train(bags, np.array([0.0, 1.0, 1.0]), epochs=1)
    first, label = np.array([0, 1, 4, 6]), np.array([0.0, 1.0, 1.0])
    x = np.concatenate(bags)

    def loss() -> float:
        p = net.forward(x, first)["score"]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    for w, g in zip(net.weights, net.backward(net.forward(x, first), first, label), strict=True):
        at = tuple(rng.integers(0, n) for n in w.shape)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - g[at]) < 1e-6
        w[at] += 1e-5


def test_samples_are_bounded_where_rows_repeat(spark, monkeypatch):
    """10,000 rows without an id or with one id and text count once in what is learnt from."""
    seen = []
    monkeypatch.setattr(language, "train", lambda windows, label, languages, seed: seen.append(len(label)))
    monkeypatch.setattr(quality, "train", lambda bags, label: seen.append([len(b) for b in bags]))
    docs = spark.range(10000).selectExpr("cast(null as bigint) doc_id", "'en' lang", "'some words of a text' text")
    language.fit(docs)
    assert seen.pop() <= 2
    long = spark.sql("select 2L doc_id, repeat('word of a long text ', 20000) text")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id bigint, quality int")
    quality.fit(docs.selectExpr("1L doc_id", "text").unionAll(long), labels, passages=16)
    assert seen.pop() == [1, 16]
