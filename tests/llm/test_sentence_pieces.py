from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import DOCUMENTS

from tallywing.llm import sentence_pieces as s
from tallywing.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
WHOLE = sentencepiece.SentencePieceProcessor(model_file=PATH)
SF = "/root/testdata/sf0.001"


def plain(text: str | None) -> tuple[list[int], str]:
    ids = WHOLE.encode(text or "")
    return ids, WHOLE.decode(ids)


def whole(codec: s.Codec, text: str) -> tuple[list[int], str]:
    import numpy as np

    ids, decoded = codec(text)
    return np.frombuffer(ids, dtype="<i4").tolist(), decoded.decode()


ODD = ["", " ", "  ", "   a", "a ", "a   b\t c", "▁", "a▁b", "▁▁ x", "<s> </s> <unk>", "<0x0A>", "\n\n x\r\n", "中文 字 한국어", "\x00 \x00a", "😀 😀😀", "é ﬁ ①", " 　 x", "﻿x �"]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert s.codec(PATH).by_chunk
    assert whole(s.codec(PATH), text) == plain(text)


@given(st.lists(st.text(max_size=40) | st.sampled_from(ODD) | st.text(" ▁ab\n", max_size=20), max_size=6))
@settings(max_examples=300, deadline=None)
def test_ids_and_text_are_those_of_the_library(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert whole(s.codec(PATH), text) == plain(text)


def test_the_table_is_bounded_and_forgets_nothing_right(monkeypatch):
    monkeypatch.setattr(s, "MOST_CHUNKS", 20)
    monkeypatch.setattr(s, "LONGEST", 8)
    codec = s.Codec(PATH)
    for k in range(6):
        text = " ".join(f"w{k}{i} the of averyverylongword{i}" for i in range(30))
        assert whole(codec, text) == plain(text)
        assert max(len(codec.new), len(codec.old), len(codec.firsts)) <= 20
        assert all(len(c) <= 8 for c in codec.new)


def test_a_model_that_may_cross_chunks_gets_whole_texts():
    codec = s.Codec(PATH)
    codec.by_chunk = False
    assert whole(codec, "  some  text ▁ here ") == plain("  some  text ▁ here ")


def test_query_against_the_library(spark, documents):
    got = sorted(tuple(r) for r in QUERIES["op13_sentence_pieces"](spark, SF).collect())
    want = []
    for r in documents.collect():
        ids, decoded = plain(r["text"])
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        want.append((r["doc_id"], len(ids), *digests))
    assert got == sorted(want)


def test_odd_rows(spark, odd):
    got = s.encode_decode(odd, PATH).collect()
    want = [(r["doc_id"], *plain(r["text"])) for r in odd.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert s.encode_decode(spark.createDataFrame([], DOCUMENTS), PATH).collect() == []
