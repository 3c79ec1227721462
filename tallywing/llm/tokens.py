"""Token ids of many texts by a public tokenizer, a word at a time.

Where the tokenizer's own settings say that words between white space never influence each other (NFC, white space
collapsed, lower case; a pattern that drops white space), each distinct word is encoded once and looked up afterwards,
which gives the ids of the whole text. Words of plain Latin letters, digits and punctuation go straight to the merge
model by the tokenizer's own pattern; all others go through the tokenizer itself. Any other tokenizer encodes whole
texts. What is remembered is bounded: it starts anew at ``MOST_WORDS`` words.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer, pre_tokenizers

from tallywing.llm.textbytes import words

MOST_WORDS = 500_000
MOST_PARTS = 150_000
#: Printable ASCII and the letters of Latin-1: NFC and lower case work on each alone.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch


@dataclass
class Known:
    """Hashes of words in ascending order, and the ids of each."""

    keys: np.ndarray
    at: np.ndarray
    ids: np.ndarray

    @staticmethod
    def nothing() -> Known:
        return Known(np.empty(0, dtype=np.uint64), np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.uint32))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is unknown."""
        spot = np.searchsorted(self.keys, keys)
        out = np.full(len(keys), -1, dtype=np.int64)
        near = np.flatnonzero(spot < len(self.keys))
        same = near[self.keys[spot[near]] == keys[near]]
        out[same] = spot[same]
        return out

    def taken(self, order: np.ndarray) -> Known:
        """The entries at ``order``."""
        begin, length = self.at[:-1][order], np.diff(self.at)[order]
        at = np.concatenate([[0], np.cumsum(length)])
        return Known(self.keys[order], at, self.ids[np.repeat(begin - at[:-1], length) + np.arange(at[-1])])

    def plus(self, other: Known) -> Known:
        both = Known(np.concatenate([self.keys, other.keys]), np.concatenate([self.at, other.at[1:] + self.at[-1]]), np.concatenate([self.ids, other.ids]))
        return both.taken(np.argsort(both.keys, kind="stable"))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, which keeps it over tasks."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        steps = (said["normalizer"] or {}).get("normalizers", [])
        split = ((said["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.by_word = (
            [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and split.get("type") == "Split"
            and split.get("behavior") == "Removed"
            and split.get("invert") is True
            and all(not x["normalized"] and not re.search(r"\s", x["content"]) for x in said["added_tokens"])
        )
        if self.by_word:
            self.find = regex.compile(split["pattern"]["Regex"]).findall
            self.added = [x["content"] for x in said["added_tokens"]]
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.spelt = {i: as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(0xC0, 0x100)}
            self.parts: dict[str, list[int]] = {}
            # New words go into a small table, which is put into the large one when it is a part of that.
            self.large, self.small = Known.nothing(), Known.nothing()

    @property
    def keys(self) -> np.ndarray:
        return np.concatenate([self.large.keys, self.small.keys])

    def _word(self, word: str) -> list[int]:
        if not _PLAIN(word) or any(x in word for x in self.added):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for part in self.find(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= MOST_PARTS:
                    self.parts.clear()
                spelt = part if part.isascii() else part.translate(self.spelt)
                ids = self.parts[part] = [x.id for x in self.tokenizer.model.tokenize(spelt)]
            out += ids
        return out

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text begin (with the end of the last). Null is empty."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            each = [np.array(x.ids, dtype=np.uint32) for x in found]
            return np.concatenate([*each, np.empty(0, dtype=np.uint32)]), np.cumsum([0, *map(len, each)])
        w = words(texts)
        keys, first, which = np.unique(w.hashes(), return_index=True, return_inverse=True)
        self._learn(w, keys, first)
        places = self.large.find(keys)
        new = places < 0
        places[new] = self.small.find(keys[new]) + len(self.large.keys)
        begins = np.concatenate([self.large.at[:-1], self.small.at[:-1] + self.large.at[-1]])
        lengths = np.concatenate([np.diff(self.large.at), np.diff(self.small.at)])
        begin, length = begins[places], lengths[places]
        count = length[which]
        at = np.concatenate([[0], np.cumsum(count)])
        all_ids = np.concatenate([self.large.ids, self.small.ids])
        ids = all_ids[np.repeat(begin[which] - at[:-1], count) + np.arange(at[-1])]
        return ids, at[w.first]

    def _learn(self, w, keys: np.ndarray, first: np.ndarray) -> None:
        """Afterwards all of ``keys``, which are in ascending order, are known."""
        in_large, in_small = self.large.find(keys), self.small.find(keys)
        new = np.flatnonzero((in_large < 0) & (in_small < 0))
        if not len(new):
            return
        if len(self.large.keys) + len(self.small.keys) + len(new) > MOST_WORDS:
            self.large, self.small = self.large.taken(in_large[in_large >= 0]), self.small.taken(in_small[in_small >= 0])
        raw = w.data.tobytes()
        found = [self._word(raw[w.starts[i] : w.ends[i]].decode()) for i in first[new]]
        at = np.cumsum([0, *map(len, found)], dtype=np.int64)
        self.small = self.small.plus(Known(keys[new], at, np.array([x for f in found for x in f], dtype=np.uint32)))
        if len(self.small.keys) > max(4096, len(self.large.keys) // 16):
            self.large, self.small = self.large.plus(self.small), Known.nothing()
