"""Language ID: a convolutional network over bytes, trained in numpy on labelled texts.

A text is cut into windows of 128 bytes, all of it. Each byte has a learned vector; filters two, three and four bytes
wide slide over a window, the greatest response of each is kept, and a softmax over these gives the languages. The
prediction for a text is the mean of its windows' log probabilities, weighted by their bytes.

The network is fitted in the driver on a bounded sample: at most ``per_language`` labelled rows of each language, those
with the least hash of their id, and two windows of each. Applying it needs no shuffle: the model is a few thousand
numbers, the vectors of bytes are folded into the filters beforehand, and batches of windows are looked up in tables.

Null texts and texts without a letter are ``und`` with a score of 0. Where no row has a label, every text is ``und``;
with one language, every text with letters has it. Repeated rows get equal results, and texts of any length are read
whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywing.llm.textbytes import buffers, by_size

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
VECTOR = 8
PAD = max(WIDTHS) - 1
#: Windows looked up at a time.
BLOCK = 512
UNKNOWN = "und"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


@dataclass
class Network:
    languages: list[str]
    vectors: np.ndarray  # 256 x VECTOR
    filters: list[np.ndarray]  # for each offset: VECTOR x (filters of all widths beyond it, widest last)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> list[np.ndarray]:
        return [self.vectors @ f for f in self.filters]

    def responses(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Of all filters at all places: windows x WINDOW x filters. ``windows`` have PAD bytes more."""
        total = np.take(tables[0], windows[:, :WINDOW], axis=0)
        for offset, table in enumerate(tables[1:], start=1):
            total[:, :, -table.shape[1] :] += np.take(table, windows[:, offset : offset + WINDOW], axis=0)
        return total

    def log_probabilities(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        for i in range(0, len(windows), BLOCK):
            pooled = self.responses(windows[i : i + BLOCK], tables).max(axis=1)
            out[i : i + BLOCK] = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        out -= out.max(axis=1, keepdims=True)
        return out - np.log(np.exp(out).sum(axis=1, keepdims=True))


def _new(languages: list[str], rng: np.random.Generator) -> Network:
    n = len(WIDTHS) * FILTERS
    # A filter of width w has weights at offsets below w; narrow filters come first.
    columns = [FILTERS * sum(w > offset for w in WIDTHS) for offset in range(max(WIDTHS))]
    normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
    return Network(
        languages,
        normal(256, VECTOR, scale=0.5),
        [normal(VECTOR, c, scale=0.25) for c in columns],
        np.zeros(n, dtype=np.float32),
        normal(n, len(languages), scale=0.1),
        np.zeros(len(languages), dtype=np.float32),
    )


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64, seed: int = 11) -> Network:
    """Adam on the cross-entropy; through max pooling, only the places of the greatest responses get a gradient."""
    rng = np.random.default_rng(seed)
    net = _new(languages, rng)
    weights = [net.vectors, *net.filters, net.bias, net.out, net.out_bias]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    n, step = len(net.bias), 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            at = order[i : i + batch]
            x = windows[at]
            response = net.responses(x, net.tables())
            place = response.argmax(axis=1)
            pooled = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            score = hidden @ net.out + net.out_bias
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), labels[at]] -= 1
            p /= len(at)
            back = (p @ net.out.T) * (pooled > 0)
            vectors, filters = np.zeros_like(net.vectors), []
            for offset, f in enumerate(net.filters):
                own = slice(n - f.shape[1], n)
                seen = x[np.arange(len(at))[:, None], place[:, own] + offset]
                g = back[:, own]
                filters.append(np.einsum("bnv,bn->vn", net.vectors[seen], g))
                np.add.at(vectors, seen.ravel(), (g[:, :, None] * f.T[None]).reshape(-1, VECTOR))
            step += 1
            rate = 0.004 * (1 - 0.8 * epoch / epochs)
            for w, g, (m, v) in zip(weights, [vectors, *filters, back.sum(0), hidden.T @ p, p.sum(0)], moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def cut(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, the text and the number of bytes of each. The bytes beyond a text are 0."""
    size = np.diff(at)
    count = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), count)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    begin = (np.arange(len(text)) - first[text]) * WINDOW
    left = size[text] - begin
    place = at[:-1][text] + begin
    padded = np.concatenate([data, np.zeros(WINDOW + PAD, dtype=np.uint8)])
    windows = padded[place[:, None] + np.arange(WINDOW + PAD)[None, :]]
    windows[np.arange(WINDOW + PAD)[None, :] >= left[:, None]] = 0
    return windows, text, np.minimum(left, WINDOW)


def _has_letter(texts: pa.Array, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
    known = seen[at[1:]] > seen[at[:-1]]
    for i in np.flatnonzero(~known & (np.diff(at) > 0)):
        known[i] = any(c.isalpha() for c in texts[i].as_py())
    return known


def fit(labelled: DataFrame, per_language: int = 1500, windows_each: int = 2, seed: int = 11) -> Network | None:
    """A network from (doc_id, text, lang); None where no row has a text and a language."""
    rows = labelled.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("hash"))
    # One row a language, of which the network itself has a column each. No text is shuffled for the sample.
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    part = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (1.2 * per_language + 50) / n))))
    place = F.shiftrightunsigned("hash", 11).cast("double") * 2.0**-53
    chosen = rows.filter(place < part[F.col("lang")])
    chosen = chosen.select("lang", "hash", _some_windows(F.col("text"), F.col("hash"), windows_each).alias("texts"))
    chosen = chosen.distinct()  # rows that repeat an id and text are one, however many they are
    sample: dict[str, list] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["hash"], r["texts"])):
        own = sample.setdefault(r["lang"], [])
        if len(own) < per_language:
            own.append(r["texts"])
    languages = sorted(sample)
    texts = [(k, t) for k, lang in enumerate(languages) for each in sample[lang] for t in each if t.strip()]
    windows, text, _ = cut(*buffers(pa.array([t for _, t in texts], pa.string())))
    return train(windows, np.array([k for k, _ in texts])[text], languages, seed=seed)


def _some_windows(text: Column, hash_: Column, n: int) -> Column:
    """``n`` stretches of the text, spread by the hash."""
    span = F.greatest(F.length(text) - F.lit(WINDOW), F.lit(0)) + 1
    start = lambda k: (F.pmod(F.xxhash64(hash_, F.lit(k)), span) + 1).cast("int")
    return F.array(*(F.substring(text, start(k), F.lit(WINDOW)) for k in range(n)))


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of each row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else []
        for b in by_size(batches, most=1 << 20):
            data, at = buffers(b.column(1))
            known = _has_letter(b.column(1), data, at) & (network is not None)
            label, score = np.full(b.num_rows, UNKNOWN, dtype=object), np.zeros(b.num_rows)
            if known.any():
                windows, text, size = cut(data, at)
                total = np.zeros((b.num_rows, len(network.languages)))
                np.add.at(total, text, network.log_probabilities(windows, tables) * size[:, None])
                mean = total[known] / np.diff(at)[known, None]
                p = np.exp(mean - mean.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                label[known] = np.array(network.languages, dtype=object)[p.argmax(axis=1)]
                score[known] = p.max(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(label, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column | str) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
