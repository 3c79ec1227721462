"""Secret scans: a trigram inverted index per block of texts, Boolean trigram queries derived from each pattern.

For a block of texts, the index lists for every queried trigram the texts that hold it. A rule's pattern is turned into
a Boolean query over trigrams that every match must contain (AND along a sequence, OR over alternatives); posting lists
are intersected and united, and only the candidates are searched with the pattern. Rules without a mandatory trigram
(such as hexadecimal runs) search every text. Index and search meet in the task that read the block: nothing is
shuffled, and an executor that is lost costs its blocks only.

Null and empty texts have no spans. Texts of any length are searched whole. Repeated rows each get their own result.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as c
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywing.llm.textbytes import buffers, by_size


@dataclass(frozen=True)
class Rule:
    """``group``: the part whose length counts; shorter matches are dropped. Kinds are ordered as listed."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    base: bool = True


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    # Hexadecimal runs are maximal, so asking for 16 at once finds the same ones as dropping shorter matches.
    Rule("hex", r"[0-9a-f]{16,}", 16),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", base=False),
    Rule("forge_token", r"\bgh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("chat_token", r"\bxox[abprs]-[A-Za-z0-9-]{20,}", base=False),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", base=False),
)

# A query is ("all",), ("tri", bytes), ("and", queries) or ("or", queries), over lower-case trigrams.
ALL = ("all",)


def _both(kind: str, parts: list[tuple]) -> tuple:
    if kind == "or" and ALL in parts:
        return ALL
    parts = [p for p in dict.fromkeys(parts) if p != ALL]
    return ALL if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _literal(text: str) -> tuple:
    """Trigrams of the bytes, A-Z lowered as in the index. Other bytes stay: outside ASCII, letters match by their own case only."""
    raw = text.encode().lower()
    return _both("and", [("tri", raw[i : i + 3]) for i in range(len(raw) - 2)])


def _strings(tree, most: int = 64) -> list[str] | None:
    """The strings that a small pattern matches, or None where they are too many or endless."""
    out = [""]
    for op, arg in tree:
        if op is c.LITERAL:
            new = [chr(arg)]
        elif op is c.SUBPATTERN:
            new = _strings(arg[-1])
        elif op is c.BRANCH:
            each = [_strings(x) for x in arg[1]]
            new = None if None in each else [s for x in each for s in x]
        elif op is c.MAX_REPEAT and arg[1] <= 4 and (one := _strings(arg[2])) and len(one) == 1:
            new = [one[0] * k for k in range(arg[0], arg[1] + 1)]
        elif op is c.IN and all(x is c.LITERAL for x, _ in arg):
            new = [chr(v) for _, v in arg]
        else:
            return None
        if new is None or len(out) * len(new) > most:
            return None
        out = [a + b for a in out for b in new]
    return out


def _query(tree) -> tuple:
    """AND over the longest finite stretches of a sequence; a stretch with several strings is an OR over them."""
    tree, parts, i = list(tree), [], 0
    while i < len(tree):
        j, known = i, None
        while j < len(tree) and (longer := _strings(tree[i : j + 1])) is not None:
            known, j = longer, j + 1
        if known is not None:
            parts.append(_both("or", [_literal(s) for s in known]))
            i = j
            continue
        op, arg = tree[i]
        if op is c.SUBPATTERN:
            parts.append(_query(arg[-1]))
        elif op is c.BRANCH:
            parts.append(_both("or", [_query(x) for x in arg[1]]))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] >= 1:
            parts.append(_query(arg[2]))
        i += 1
    return _both("and", parts)


@lru_cache(maxsize=256)
def trigram_query(pattern: str) -> tuple:
    """What every match of the pattern must contain."""
    return _query(_parser.parse(pattern))


def _trigrams(query: tuple) -> set[bytes]:
    return {query[1]} if query[0] == "tri" else set() if query == ALL else {t for q in query[1] for t in _trigrams(q)}


@lru_cache(maxsize=1)
def _numbers(order: tuple[bytes, ...]) -> np.ndarray:
    """The place of each trigram in ``order``, from 1; 0 for all others. One byte each where that is enough."""
    number = np.zeros(1 << 24, dtype=np.min_scalar_type(len(order)))
    for k, t in enumerate(order, 1):
        number[int.from_bytes(t, "big")] = k
    return number


class BlockIndex:
    """Posting lists (sorted text numbers) of the wanted trigrams over one block of texts."""

    def __init__(self, texts: pa.Array, wanted: set[bytes]):
        self.texts = len(texts)
        data, at = buffers(texts)
        self.postings: dict[bytes, np.ndarray] = {t: np.empty(0, dtype=np.int64) for t in wanted}
        if len(data) < 3 or not wanted:
            return
        lower = np.arange(256, dtype=np.uint32)
        lower[ord("A") : ord("Z") + 1] += 32
        x = lower[data]
        codes = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
        order = sorted(wanted)
        number = _numbers(tuple(order))
        where = np.flatnonzero(number[codes])
        text = np.searchsorted(at, where, "right") - 1
        inside = where + 3 <= at[text + 1]
        which, text = number[codes[where[inside]]].astype(np.int64) - 1, text[inside]
        pairs = np.unique(which * self.texts + text)
        for k, part in enumerate(np.split(pairs, np.searchsorted(pairs, np.arange(1, len(order)) * self.texts))):
            self.postings[order[k]] = part - k * self.texts

    def candidates(self, query: tuple) -> np.ndarray:
        if query == ALL:
            return np.arange(self.texts)
        if query[0] == "tri":
            return self.postings[query[1]]
        parts = sorted((self.candidates(q) for q in query[1]), key=len)
        out = parts[0]
        for p in parts[1:]:
            out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
        return out


def spans_of(texts: pa.Array, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) of every match, by start and then rule, for each text."""
    wanted = {t for r in rules for t in _trigrams(trigram_query(r.pattern))}
    index, found = BlockIndex(texts, wanted), [[] for _ in range(len(texts))]
    strings: dict[int, str] = {}
    for k, rule in enumerate(rules):
        search = re.compile(rule.pattern, re.ASCII).finditer
        for i in map(int, index.candidates(trigram_query(rule.pattern))):
            if i not in strings:
                strings[i] = texts[i].as_py() or ""
            for m in search(strings[i]):
                if len(m[rule.group]) >= rule.least:
                    found[i].append((m.start(), k, m.end()))
    return [sorted(x) for x in found]


def scan(docs: DataFrame, key: Column | str = "doc_id", text: Column | str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``key``, ``n_<kind>`` of each base kind, ``base_sha256`` and ``spans``: one row for each row of ``docs``."""
    key, text = (F.col(x) if isinstance(x, str) else x for x in (key, text))
    base = [r for r in rules if r.base]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            all_spans = spans_of(b.column(1), rules)
            kept = [[x for x in s if rules[x[1]].base] for s in all_spans]
            said = [[",".join(f"{rules[k].kind}:{i}:{j}" for i, k, j in s) for s in which] for which in (kept, all_spans)]
            counts = [pa.array([sum(rules[k].kind == r.kind for _, k, _ in s) for s in kept], pa.int64()) for r in base]
            digest = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in said[0]], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digest, pa.array(said[1], pa.string())], names)

    names = ["key", *(f"n_{r.kind}" for r in base), "base_sha256", "spans"]
    narrow = docs.select(key.alias("key"), text.alias("text"))
    kind = narrow.schema["key"].dataType.simpleString()
    schema = f"key {kind}, " + ", ".join(f"n_{r.kind} bigint" for r in base) + ", base_sha256 string, spans string"
    return narrow.mapInArrow(search, schema)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with each stretch of secrets in ``text`` replaced by ``[kind]`` (that of its first span); null stays null.

    Every column stays as it is, but for ``text`` and, where there is one, ``n_chars``.
    """

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches):
            at = b.schema.get_field_index("text")
            texts = b.column(at).to_pylist()
            for i, spans in enumerate(spans_of(b.column(at), rules)):
                if spans:
                    out, end = [], 0
                    for start, k, stop in spans:
                        if start >= end:
                            out += [texts[i][end:start], f"[{rules[k].kind}]"]
                        end = max(end, stop)
                    texts[i] = "".join([*out, texts[i][end:]])
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
