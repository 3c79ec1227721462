"""Substring dedup: windows of 50 words that also start in a document with a smaller id, by super-k-mer partitioning.

Every window of ``length`` consecutive words has a minimiser: the least hash of its runs of ``seed`` words. Consecutive
windows with the same minimiser form one super-k-mer. Equal windows have equal minimisers, so

1. super-k-mers are listed as (minimiser, document, place), some 16 bytes for about 20 words, and minimisers that occur
   in one document only are left out, since none of their windows can repeat;
2. the super-k-mers that remain travel to the bucket of their minimiser, each as one packed string (its words joined by
   one space), where sorting their windows, as strings, finds the smallest document of each exactly;
3. minimisers with more than ``hot`` super-k-mers (a passage or line in very many documents) are split: their windows
   travel as two 64-bit digests, which Spark combines map-side and deals out evenly by window. No bucket is unbounded;
4. covered words are removed from each document in one join by document.

Texts without words and documents shorter than a window keep all their words. Null text counts as empty. A null id comes
before all others. Rows with the same id are one document: nothing is removed for a repeat under the same id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywing.llm.shared import checkpointed
from tallywing.llm.textbytes import Words, by_size, mix, words

LEAST = -(1 << 63)  # stands for a null id
STRETCH = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def _minimisers(w: Words, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word (of the batch), number of windows and minimiser of each super-k-mer."""
    none = np.empty(0, dtype=np.int64)
    h = w.hashes()
    if len(h) < length:
        return none, none, none, none
    runs = np.zeros(len(h) - seed + 1, dtype=np.uint64)
    for k in range(seed):
        runs = runs * np.uint64(0xC2B2AE3D27D4EB4F) + h[k : len(h) - seed + 1 + k]
    least, span, want = mix(runs), 1, length - seed + 1
    while span < want:  # the minimum over span, 2 * span, ... and finally over the runs of a window
        step = min(span, want - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    at = np.arange(len(least))
    text = np.searchsorted(w.first, at, "right") - 1
    valid = at + length <= w.first[text + 1]
    at, text, least = at[valid], text[valid], least[valid]
    if not len(at):
        return none, none, none, none
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    return text[begin], at[begin], np.diff(np.append(begin, len(at))), least[begin].view(np.int64)


def _ids(b: pa.RecordBatch, column: str = "doc_id") -> list[int]:
    return b.column(b.schema.get_field_index(column)).to_pylist()


def _list(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in by_size(batches):
        w, ids = words(b.column(1)), np.array(_ids(b), dtype=np.int64)
        text, start, count, least = _minimisers(w, length, seed)
        first = (start - w.first[text]).astype(np.int32)
        mark = b.column(2).to_numpy()[text]
        columns = [pa.array(x) for x in (least, ids[text], mark, first, count.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["minimiser", "doc_id", "mark", "start", "windows"])


def _strings(b: pa.RecordBatch, length: int) -> Iterator[tuple[tuple[int, int], int, int, bool, list[bytes]]]:
    """Document, minimiser, start, whether hot, and the words of each listed super-k-mer of a batch of documents."""
    for doc, text, found in zip(zip(_ids(b), _ids(b, "mark"), strict=True), b.column(1), b.column(3), strict=True):
        own = (text.as_py() or "").encode().split()  # at white space 0x20 and 0x09-0x0D
        for x in found.as_py():
            yield doc, x["minimiser"], x["start"], x["hot"], own[x["start"] : x["start"] + x["windows"] + length - 1]


def _pack(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in by_size(batches, most=2 << 20):
        rows = [(m, *d, s, b" ".join(w)) for d, m, s, hot, w in _strings(b, length) if not hot]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        yield _batch(rows, kinds, ["minimiser", "doc_id", "mark", "start", "packed"])


def _digests(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in by_size(batches, most=2 << 20):
        rows = []
        for d, _, s, hot, w in _strings(b, length):
            for k in range(len(w) - length + 1 if hot else 0):
                x = hashlib.blake2b(b" ".join(w[k : k + length]), digest_size=16).digest()
                high, low = (int.from_bytes(half, "big", signed=True) for half in (x[:8], x[8:]))
                rows.append((high, low, *d, s + k))
        yield _batch(rows, [pa.int64()] * 4 + [pa.int32()], ["high", "low", "doc_id", "mark", "start"])


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _sorted_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by minimiser. Stretches of covered windows, by document."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    out: list[tuple] = []
    for _, group in groupby(rows, key=lambda r: r[0]):
        windows = []
        for _, doc, mark, start, packed in group:
            cut = [-1, *(i for i, c in enumerate(packed) if c == 32), len(packed)]
            windows += [(packed[cut[k] + 1 : cut[k + length]], doc, mark, start + k) for k in range(len(cut) - length)]
        windows.sort()
        covered = []
        for i, (x, doc, mark, start) in enumerate(windows):
            if i == 0 or x != windows[i - 1][0]:
                least = doc
            if doc > least:
                covered.append((doc, mark, start))
        out += stretches(covered)
        if len(out) >= 20000:
            yield _batch(out, STRETCH, ["doc_id", "mark", "start", "windows"])
            out = []
    yield _batch(out, STRETCH, ["doc_id", "mark", "start", "windows"])


def stretches(covered: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Consecutive windows of a document as one row: document, its mark, first window, number of windows."""
    out: list[tuple[int, int, int, int]] = []
    for doc, mark, start in sorted(covered):
        if out and out[-1][:2] == (doc, mark) and out[-1][2] + out[-1][3] >= start:
            out[-1] = (doc, mark, out[-1][2], max(out[-1][3], start + 1 - out[-1][2]))
        else:
            out.append((doc, mark, start, 1))
    return out


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, with their length before, as they are stored and shuffled once more. Null is empty."""
    for b in batches:
        raw = [(t or "").encode() for t in b.column(1).to_pylist()]
        small = [len(t).to_bytes(8, "little") + pa.compress(t, "zstd", asbytes=True) for t in raw]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(small, pa.binary()), b.column(2)], ["doc_id", "squeezed", "mark"])


def _loosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts again, a few hundred at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, 500):
            b = whole.slice(i, 500)
            raw = [pa.decompress(x[8:], int.from_bytes(x[:8], "little"), "zstd", asbytes=True) for x in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array(raw, pa.binary()).cast(pa.large_string()), *b.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", *b.schema.names[2:]])


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in by_size(batches, most=4 << 20):
        rows = []
        for doc, text, found in zip(_ids(b), b.column(1), b.column(2), strict=True):
            own = (text.as_py() or "").encode().split()
            keep = np.ones(len(own), dtype=bool)
            for x in found.as_py() or ():
                keep[x["start"] : x["start"] + x["windows"] + length - 1] = False
            kept = b" ".join(own[i] for i in np.flatnonzero(keep)) if not keep.all() else b" ".join(own)
            rows.append((doc, len(own), len(own) - int(keep.sum()), kept.decode()))
        yield _batch(rows, [pa.int64(), pa.int64(), pa.int64(), pa.string()], ["doc_id", "n_words", "n_removed", "kept"])


def covered_windows(docs: DataFrame, length: int = 50, seed: int = 12, hot: int = 4096) -> DataFrame:
    """Stretches (doc_id, mark, start, windows) of windows that also start in a document with a smaller id.

    ``docs`` has doc_id, text and mark, which tells rows with the same id apart.
    """
    listed = docs.mapInArrow(lambda it: _list(it, length, seed), "minimiser bigint, doc_id bigint, mark bigint, start int, windows int")
    listed = checkpointed(listed)
    shared = listed.groupBy("minimiser").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n"))
    shared = shared.filter("a < b").select("minimiser", (F.col("n") > hot).alias("hot"))
    # As a set: equal rows under one id list the same super-k-mers, which are to be looked at once.
    found = listed.join(shared, "minimiser")
    found = found.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("minimiser", "start", "windows", "hot")).alias("found"))
    squeezed = docs.select("doc_id", "text", "mark").mapInArrow(_squeeze, "doc_id bigint, squeezed binary, mark bigint")
    joined = squeezed.join(found, ["doc_id", "mark"])
    first = F.row_number().over(Window.partitionBy("doc_id", "mark").orderBy(F.lit(1)))
    one = joined.withColumn("place", first).filter("place = 1")
    with_text = checkpointed(one.select("doc_id", "squeezed", "mark", "found"))
    packed = with_text.mapInArrow(
        lambda it: _pack(_loosen(it), length), "minimiser bigint, doc_id bigint, mark bigint, start int, packed binary"
    )
    buckets = packed.repartition("minimiser").sortWithinPartitions("minimiser")
    cold = buckets.mapInArrow(lambda it: _sorted_windows(it, length), "doc_id bigint, mark bigint, start int, windows int")
    windows = with_text.filter(F.exists("found", lambda x: x["hot"]))
    windows = windows.mapInArrow(lambda it: _digests(_loosen(it), length), "high bigint, low bigint, doc_id bigint, mark bigint, start int")
    least = windows.groupBy("high", "low").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = least.filter("least < most").drop("most")
    again = windows.join(least, ["high", "low"]).filter("doc_id > least")
    return cold.unionAll(again.select("doc_id", "mark", "start", F.lit(1).alias("windows")))


def remove_repeats(docs: DataFrame, length: int = 50, seed: int = 12, hot: int = 4096) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept`` (the words that stay, joined by one space) of each row."""
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("doc_id"), "text")
    narrow = narrow.withColumn("mark", F.xxhash64("text"))
    covered = covered_windows(narrow, length, seed, hot)
    by_doc = covered.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "windows")).alias("found"))
    joined = narrow.join(by_doc, ["doc_id", "mark"], "left").select("doc_id", "text", "found")
    out = joined.mapInArrow(lambda it: _remove(it, length), "doc_id bigint, n_words bigint, n_removed bigint, kept string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != LEAST, F.col("doc_id")))
