"""Each stage against a plain version of it, on its own input."""

from __future__ import annotations

import importlib.util
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from test_weighted_minhash import brute
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

from tallywing.llm import mixing, quality, weighted_minhash  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """The input of the first stage and what each stage returns, written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(frame) -> Counter:
    return Counter(map(tuple, frame.select(*corpus_pipeline.COLUMNS).collect()))


def test_columns(results):
    assert all(x.columns == results[0].columns for x in results[1:-1])


def test_quality(spark, results):
    network = quality.learnt_from(results[0], spark.read.parquet(f"{SF}/labels.parquet"))
    every = results[0].collect()
    x, first = quality.features(pa.array([r["text"] for r in every]))
    score = network.forward(x.astype(np.float64), first)["score"]
    assert rows(results[1]) == Counter(tuple(r) for r, s in zip(every, score, strict=True) if s >= 0.5)


def test_near_duplicates(results):
    every = results[1].collect()
    weight = weighted_minhash.inverse_frequencies(results[1])
    classes = brute([(r["doc_id"], r["text"]) for r in every], weight)
    assert rows(results[2]) == Counter(tuple(r) for r in every if classes[r["doc_id"]] == r["doc_id"])


def test_secrets(results):
    assign = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?[A-Za-z0-9+/_.=-]{12,}"""
    want = Counter()
    for r in results[2].collect():
        marks = np.zeros(len(r["text"]) + 1, dtype=int)
        spans = []
        for kind, pattern in (("assign", assign), ("access", r"AKIA[A-Z0-9]{14,}"), ("hex", r"[0-9a-f]{16,}")):
            spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, r["text"])]
        text, end = "", 0
        for i, kind, j in sorted(spans, key=lambda s: (s[0], ["assign", "access", "hex"].index(s[1]))):
            if i >= end:
                text += r["text"][end:i] + f"[{kind}]"
            end = max(end, j)
            marks[i:j] = 1
        text += r["text"][end:]
        want[(r["doc_id"], text, r["lang"], r["source"], len(text))] += 1
    assert rows(results[3]) == want


def test_mix(results):
    times = {(r["doc_id"]): r["copies"] for r in mixing.mix(results[3]).collect()}
    want = Counter({tuple(r): times[r["doc_id"]] for r in results[3].select(*corpus_pipeline.COLUMNS).collect()})
    assert rows(results[4]) == +want


def test_packing(results):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in results[4].collect()}
    times = Counter(r["doc_id"] for r in results[4].collect())
    taken: Counter = Counter()
    for r in results[5].collect():
        assert r["doc_tokens"] == total[r["doc_id"]]
        taken[r["doc_id"]] += r["length"]
    assert taken == Counter({d: n * total[d] for d, n in times.items()})


def test_run_gives_what_the_stages_give(spark, results):
    got = corpus_pipeline.run(spark, SF)
    digest = lambda f: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in f.collect())
    one, other = digest(got), digest(results[5])
    assert {d for d, *_ in one} == {d for d, *_ in other}
    assert sum(n * k[2] for k, n in one.items()) == sum(n * k[2] for k, n in other.items())


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows_and_empty_tables(spark, odd, number):
    _, stage = corpus_pipeline.STAGES[number]
    got = stage(spark, odd, SF)
    assert got.columns == (corpus_pipeline.COLUMNS if number < 4 else got.columns)
    got.collect()
    assert stage(spark, odd.limit(0), SF).collect() == []


def test_module_is_found():
    assert importlib.util.find_spec("corpus_pipeline")
