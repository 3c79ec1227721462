"""Packing: documents into sequences of a fixed number of tokens, by sum-of-squares online packing.

Each task packs the documents of its own input split, one after the other as they are read: full windows are cut from a
long document, and the rest goes to the fill level (an open window of that fill, or a new one) that makes the sum of
squared counts of partly filled windows least. The counts are kept in an array by level, so a document costs one pass
over that array. At the end of the split (or beyond ``most_open`` open windows) the open windows are settled: documents
of the emptiest are cut to fill the fullest, so that one window a split is not full. Nothing is shuffled and memory is
bounded by the open windows; a task that is run again reads the same split and gives the same sequences.

Null and empty texts are documents of the end token alone. Repeated rows are packed each. A null id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tallywing.llm.textbytes import by_size
from tallywing.llm.tokens import encoder

Piece = tuple[int | None, int, np.ndarray, int]  # document, start in it, ids, tokens of the document

SCHEMA = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class SumOfSquares:
    """Open windows by fill level. ``add`` and ``settle`` return the windows that are done, as lists of pieces."""

    def __init__(self, size: int, most_open: int = 4096):
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.windows: dict[int, list[list[Piece]]] = {}
        self.open = 0

    def level(self, length: int) -> int:
        """The fill level to add ``length`` to; 0 is a new window. Ties go to the fullest."""
        size, n = self.size, self.counts
        here, there = n[: size - length + 1], n[length:]
        change = 2 * (there - here) + 2
        change[-1] -= 1  # a window that gets full is no longer counted
        change[here == 0] = np.iinfo(np.int64).max
        change[0] = 2 * n[length] + 1
        return size - length - int(np.argmin(change[::-1]))

    def add(self, document: int | None, ids: np.ndarray) -> Iterator[list[Piece]]:
        whole = len(ids) // self.size * self.size
        for i in range(0, whole, self.size):
            yield [(document, i, ids[i : i + self.size], len(ids))]
        if rest := len(ids) - whole:
            at = self.level(rest)
            window = self.windows[at].pop() if at else []
            window.append((document, whole, ids[whole:], len(ids)))
            self.open += not at
            self.counts[at] -= at > 0
            if at + rest == self.size:
                self.open -= 1
                yield window
            else:
                self.counts[at + rest] += 1
                self.windows.setdefault(at + rest, []).append(window)
            if self.open > self.most_open:
                yield from self.settle()

    def settle(self) -> Iterator[list[Piece]]:
        """Fill the fullest windows by pieces of the emptiest."""
        left = [w for fill in sorted(self.windows) for w in self.windows[fill]]
        low = 0
        while low < len(left):
            window = left.pop()
            room = self.size - sum(len(p[2]) for p in window)
            while room and low < len(left):
                document, start, ids, total = left[low].pop()
                window.append((document, start, ids[:room], total))
                if len(ids) > room:
                    left[low].append((document, start + room, ids[room:], total))
                room -= min(room, len(ids))
                low += not left[low]
            yield window
        self.counts[:], self.windows, self.open = 0, {}, 0


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2) -> DataFrame:
    """One row for each piece of a document: where it is cut from, and its sequence and offset there."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), SumOfSquares(size)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def put(windows: Iterator[list[Piece]]) -> None:
            nonlocal number
            for window in windows:
                offset = 0
                for document, start, ids, total in window:
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((document, start, len(ids), crc, total, number, offset))
                    offset += len(ids)
                number += 1

        def taken(key: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            out = [pa.array(c, key if k == 0 else pa.int64()) for k, c in enumerate(columns)]
            rows.clear()
            return pa.RecordBatch.from_arrays(out, names)

        key = None
        for b in by_size(batches):
            key = b.column(0).type
            ids, at = encode(b.column(1))
            for k, document in enumerate(b.column(0).to_pylist()):
                put(packer.add(document, np.append(ids[at[k] : at[k + 1]], np.uint32(end_id))))
            if len(rows) >= 5000:
                yield taken(key)
        if key is not None:
            put(packer.settle())
            yield taken(key)

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA.format(kind))
