"""SentencePiece ids of whole texts, and the text these ids decode to, by a table of distinct chunks.

A chunk is a run of spaces (or literal markers, U+2581) and the characters up to the next one; the library puts one space
before every text. Where no piece of the model has a marker behind another character, nothing can be merged across the
beginning of a chunk, so each distinct chunk is segmented once, its ids and their decoded text are kept in a table, and
those of a text are put together by position. The first chunk of a text decodes without the space that was put before
it, so it has an entry of its own kind. Whether a model allows this is asked of the model; any other one gets whole texts.

Each task has its own table: no row is shuffled, and what a lost executor had learnt is learnt again. The table is
bounded: ``MOST_CHUNKS`` of ``LONGEST`` characters at most are kept in each of two generations, the older of which goes
when the newer is full, and what was found in the older moves on. Longer chunks are segmented where they occur.

Null texts are empty; an empty text has no ids and decodes to an empty text. Repeated rows and rows without an id give a
row each; other columns are left out. Texts are never cut, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallywing.llm.textbytes import by_size

MARK = "▁"
MOST_CHUNKS = 150_000
LONGEST = 200
_CHUNKS = re.compile(" +[^ ]*").findall
#: What a model that does no more than escape spaces leaves as it is.
_PROBE = "  A b\t\n\xa0ﬁ①　Å éx  ğ\x00 "

Entry = tuple[bytes, bytes]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each worker process, which keeps it over tasks."""
    return Codec(path)


class Codec:
    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.mark_id = self.library.piece_to_id(MARK)
        self.by_chunk = (
            not self.library.is_unknown(self.mark_id)
            and not any(MARK in p.lstrip(MARK) for p in pieces)
            and self.library.normalize(_PROBE) == (MARK + _PROBE).replace(" ", MARK)
        )
        # What the library reads as one symbol wherever it stands could hold a space: such a model has to see whole texts.
        self.by_chunk = self.by_chunk and not any(" " in p for p in pieces)
        self.before = self.library.encode("a")
        self.cut = len(self.library.decode(self.before).encode())
        self.new: dict[str, Entry] = {}
        self.old: dict[str, Entry] = {}
        self.firsts: dict[str, Entry] = {}

    def _segment(self, chunk: str) -> list[int]:
        """``chunk`` begins with a space, which the library puts there itself; it takes an empty text for no text."""
        return self.library.encode(chunk[1:]) if len(chunk) > 1 else [self.mark_id]

    def _first(self, chunk: str) -> Entry:
        entry = self.firsts.get(chunk)
        if entry is None:
            ids = self._segment(chunk)
            entry = np.array(ids, dtype="<i4").tobytes(), self.library.decode(ids).encode()
            if len(chunk) <= LONGEST:
                if len(self.firsts) >= MOST_CHUNKS:
                    self.firsts.clear()
                self.firsts[chunk] = entry
        return entry

    def _learn(self, chunk: str) -> Entry:
        entry = self.old.get(chunk)
        if entry is None:
            ids = self._segment(chunk)
            entry = np.array(ids, dtype="<i4").tobytes(), self.library.decode(self.before + ids).encode()[self.cut :]
        if len(chunk) <= LONGEST:
            if len(self.new) >= MOST_CHUNKS:
                self.old, self.new = self.new, {}
            self.new[chunk] = entry
        return entry

    def __call__(self, text: str) -> Entry:
        """The ids, as little-endian 32-bit numbers, and the decoded text in UTF-8."""
        if not text:
            return b"", b""
        if not self.by_chunk:
            ids = self.library.encode(text)
            return np.array(ids, dtype="<i4").tobytes(), self.library.decode(ids).encode()
        first, *rest = _CHUNKS(" " + text.replace(MARK, " "))
        known = self.new.get
        entries = [self._first(first), *[known(c) or self._learn(c) for c in rest]]
        return b"".join([e[0] for e in entries]), b"".join([e[1] for e in entries])


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` (array of int) and ``decoded`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(model)
        for b in by_size(batches, text):
            found = [code(t or "") for t in b.column(1).to_pylist()]
            at = np.cumsum([0, *(len(i) // 4 for i, _ in found)], dtype=np.int32)
            ids = pa.array(np.frombuffer(b"".join([i for i, _ in found]), dtype="<i4"))
            decoded = pa.array([d for _, d in found], pa.binary()).cast(pa.string())
            columns = [b.column(0), pa.ListArray.from_arrays(pa.array(at), ids), decoded]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>, decoded string")
