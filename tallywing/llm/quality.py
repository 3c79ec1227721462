"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A text is the bag of its passages of 64 words, all of them. Each passage is described by shares of kinds of characters
and words and of repeats, and encoded by a learned layer. Gated attention (tanh times sigmoid) learns from the label of
the document alone how much each passage counts, and a logistic layer scores the weighted representation.

The network is fitted in the driver on a bounded sample: at most ``most`` labelled documents, those with the least hash
of their id. Applying it needs no shuffle.

Null and empty texts are one empty passage and get the score of that. Where there are no labels every score is 1.
Repeated rows get equal scores. Several labels of one document are several examples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywing.llm.textbytes import SPACE, by_size, words

PASSAGE = 64
HIDDEN, GATE = 24, 12

_KIND = np.zeros(256, dtype=np.int64)  # 0: other ASCII
for _k, _chars in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,", "!?", ";:'\"-()", "|", "#", "$%&*", "<>{}[]\\/=_"], start=1):
    _KIND[[ord(c) for c in _chars]] = _k
_KIND[128:] = 11
_KIND[SPACE] = 12
KINDS = 13
FEATURES = KINDS + 11


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row for each passage, and where the passages of each text begin (with the end of the last)."""
    w = words(texts)
    h = w.hashes()
    counts = np.diff(w.first)
    passages = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    out = np.zeros((first[-1], FEATURES), dtype=np.float32)
    if not len(h):
        return out, first
    text = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(h)) - w.first[text]
    passage = first[text] + number // PASSAGE
    n = np.bincount(passage, minlength=len(out)).astype(np.float32)
    n[n == 0] = 1
    length = (w.ends - w.starts).astype(np.float32)

    # Kinds of bytes, by running counts at the bytes of each word.
    kind = _KIND[w.data]
    inside = np.flatnonzero(kind != 12)
    of = np.searchsorted(w.starts, inside, "right") - 1
    table = np.bincount(passage[of] * KINDS + kind[inside], minlength=len(out) * KINDS).reshape(-1, KINDS)
    size = np.maximum(table.sum(axis=1, keepdims=True), 1)
    out[:, :KINDS] = table / size

    share = lambda mask: np.bincount(passage, mask, len(out)) / n
    start, end = kind[w.starts], kind[w.ends - 1]
    next_ = np.minimum(w.starts + 1, w.ends - 1)
    before = np.append(False, (h[1:] == h[:-1]) & (passage[1:] == passage[:-1]))
    order = np.lexsort((h, passage))
    same = np.append(False, (h[order][1:] == h[order][:-1]) & (passage[order][1:] == passage[order][:-1]))
    lines = np.zeros(len(w.data) + 1, dtype=np.int64)
    np.cumsum(w.data == 10, out=lines[1:])
    broken = np.append(0, np.diff(lines[w.starts]) > 0)
    mean = share(length)
    extra = [
        mean / 10,
        np.sqrt(np.maximum(share(length**2) - mean**2, 0)) / 10,
        share(before),
        np.bincount(passage[order], same, len(out)) / n,
        share(start == 2),
        share((start == 2) & (kind[next_] == 2)),
        share((length == 1) & (start != 1) & (start != 2) & (start != 11)),
        share((end != 1) & (end != 2) & (end != 11)),
        share(end == 4),
        share(broken),
        np.minimum(n, PASSAGE) / PASSAGE,
    ]
    out[:, KINDS:] = np.stack(extra, axis=1)
    out[n == 0] = 0
    empty = first[:-1][counts == 0]
    out[empty] = 0
    return out, first


@dataclass
class Network:
    middle: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]  # encoder and bias, tanh gate, sigmoid gate, attention, output and bias

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        encode, bias, tanh, sigmoid, attend, out, out_bias = self.weights
        x = (x - self.middle) / self.scale
        h = np.tanh(x @ encode + bias)
        t, s = np.tanh(h @ tanh), 1 / (1 + np.exp(-(h @ sigmoid)))
        e = (t * s) @ attend
        at, n = first[:-1], np.diff(first)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(a[:, None] * h, at)
        score = 1 / (1 + np.exp(-np.clip(z @ out + out_bias[0], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "score": score}

    def backward(self, f: dict[str, np.ndarray], first: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of the weights."""
        _, _, tanh, sigmoid, attend, out, _ = self.weights
        n = np.diff(first)
        d = (f["score"] - label) / len(label)
        dz = np.repeat(d[:, None] * out[None], n, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first[:-1]), n))
        dg = de[:, None] * attend[None]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz + dt @ tanh.T + ds @ sigmoid.T
        dx = dh * (1 - f["h"] ** 2)
        return [f["x"].T @ dx, dx.sum(0), f["h"].T @ dt, f["h"].T @ ds, (f["t"] * f["s"]).T @ de, f["z"].T @ d, np.array([d.sum()])]


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 60, batch: int = 64, seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(np.float64)
    shapes = [(FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,)]
    weights = [rng.normal(0, 0.3, s) if i not in (1, 6) else np.zeros(s) for i, s in enumerate(shapes)]
    net = Network(every.mean(axis=0), every.std(axis=0) + 1e-2, weights)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            at = order[i : i + batch]
            first = np.concatenate([[0], np.cumsum([len(bags[k]) for k in at])])
            f = net.forward(np.concatenate([bags[k] for k in at]).astype(np.float64), first)
            step += 1
            rate = 0.005 * (1 - 0.9 * epoch / epochs)
            for w, g, (m, v) in zip(weights, net.backward(f, first, labels[at]), moments, strict=True):
                m += 0.1 * (g + 1e-5 * w - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, most: int = 6000, passages: int = 512) -> Network | None:
    """From (doc_id, text) and (doc_id, quality); None where nothing is labelled.

    At most ``most`` labelled ids are learnt from, one text of each label of an id however many rows repeat it, and at
    most ``passages`` passages of a text, spread evenly. Scores use all passages.
    """
    known = labels.filter("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(most)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, most=2 << 20):
            x, first = features(b.column(2))
            spread = (i + np.unique(np.linspace(0, j - i - 1, min(passages, j - i)).astype(np.int64)) for i, j in zip(first[:-1], first[1:], strict=True))
            rows = [x[k].tobytes() for k in spread]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.binary())], ["doc_id", "label", "bag"])

    rows = docs.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("bigint").alias("doc_id"), "label", "text")
    bags = rows.mapInArrow(describe, "doc_id bigint, label int, bag binary").groupBy("doc_id", "label").agg(F.min("bag").alias("bag"))
    found = sorted(tuple(r) for r in bags.collect())
    if not found:
        return None
    bags = [np.frombuffer(b, dtype=np.float32).reshape(-1, FEATURES) for _, _, b in found]
    return train(bags, np.array([label for _, label, _ in found], dtype=np.float64))


def scores(docs: DataFrame, network: Network | None, out: str = "score") -> DataFrame:
    """Every column of ``docs``, and ``out``, which takes the place of a column of that name."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, most=2 << 20):
            x, first = features(b.column(b.schema.get_field_index("text")))
            score = network.forward(x.astype(np.float64), first)["score"] if network else np.ones(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*b.schema.names, out])

    others = docs.drop(out)
    return others.mapInArrow(apply, others.withColumn(out, F.lit(0.0)).schema)


def held_out(doc_id: str) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 3, is 1. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learnt_from(docs: DataFrame, labels: DataFrame) -> Network | None:
    return fit(docs.select("doc_id", "text"), labels.filter(~held_out("doc_id")))


def good(docs: DataFrame, network: Network | None) -> DataFrame:
    """The rows of ``docs`` with a score of a half or more."""
    return scores(docs, network, "__score").filter("__score >= 0.5").drop("__score")
