from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS
from tokenizers import Tokenizer

from tallywing.llm import packing as p
from tallywing.llm.tokens import Encoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids_of(text: str | None) -> list[int]:
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(max_size=60) | st.sampled_from(["<|endoftext|>", "it's", "ÀÉ ß ſ İ ΣΑΣ", "á e ́x", "\x1c\x85\xa0", "中文 12 ½"]), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_whole_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, at = encoder(PATH)(pa.array(texts, pa.string()))
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [ids_of(t) for t in texts]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("tallywing.llm.tokens.MOST_WORDS", 50)
    monkeypatch.setattr("tallywing.llm.tokens.MOST_PARTS", 20)
    one = Encoder(PATH)
    for k in range(5):
        text = " ".join(f"word{k}x{i}, Other" for i in range(40))
        assert one(pa.array([text]))[0].tolist() == ids_of(text)
        assert len(one.keys) <= 90


@pytest.mark.parametrize("file", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(file):
    path = public_tokenizers.path(file)
    text = "some  text here"
    assert encoder(path)(pa.array([text, None]))[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_level_makes_the_sum_of_squares_least():
    rng = random.Random(1)
    packer = p.SumOfSquares(40)
    for _ in range(400):
        length = rng.randint(1, 39)
        costs = {}
        for h in range(0, 40 - length + 1):
            if h and not packer.counts[h]:
                continue
            n = packer.counts.copy()
            n[h] -= h > 0
            if h + length < 40:
                n[h + length] += 1
            costs[h] = int((n**2).sum())
        level = packer.level(length)
        assert costs[level] == min(costs.values())
        assert level == max(h for h, c in costs.items() if c == costs[level])
        list(packer.add(None, np.zeros(length, dtype=np.uint32)))


def check(frame, size=4096) -> tuple[int, int]:
    tokens: dict = defaultdict(list)
    for r in frame.select("doc_id", "text").collect():
        tokens[r["doc_id"]].append([*ids_of(r["text"]), 2])
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in p.pack(frame, PATH, size).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == tokens.keys()
    for d, rows in pieces.items():
        if len(tokens[d]) > 1:
            assert sum(r["length"] for r in rows) == sum(map(len, tokens[d]))
            continue
        end = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == end and r["doc_tokens"] == len(tokens[d][0]) and r["length"] > 0
            end += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(tokens[d][0][r["start"] : end], dtype="<u4").tobytes())
        assert end == len(tokens[d][0])
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return sum(len(x) for each in tokens.values() for x in each), len(sequences) * size


@pytest.mark.parametrize("size", [64, 1000, 4096])
def test_round_trip(documents, size):
    used, room = check(documents, size)
    assert room - used <= size * documents.rdd.getNumPartitions()


def test_odd_rows_and_few_open_windows(spark, odd, monkeypatch):
    check(odd)
    assert p.pack(spark.createDataFrame([], DOCUMENTS), PATH).collect() == []
    packer = p.SumOfSquares(50, most_open=3)
    rng = random.Random(4)
    done = [w for k in range(300) for w in packer.add(k, np.arange(rng.randint(1, 120), dtype=np.uint32))]
    done += list(packer.settle())
    seen = defaultdict(list)
    for w in done:
        assert sum(len(x[2]) for x in w) <= 50
        for d, start, ids, _ in w:
            seen[d].append((start, ids))
    for parts in seen.values():
        parts.sort(key=lambda x: x[0])
        assert np.concatenate([x for _, x in parts]).tolist() == list(range(sum(len(x) for _, x in parts)))
