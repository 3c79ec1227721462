"""Words, hashes and byte views of a batch of texts, worked out on the Arrow buffers by whole-array arithmetic.

A word is a run of bytes other than the white space 0x20 and 0x09-0x0D, which is the same as ``[^\\x20\\x09-\\x0D]+``
over code points. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes hashed at a time.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, and 5 modulo 8, so that its powers run through a long cycle
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PIECE + 4096), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= PIECE + 4096:
            _powers[int(base)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """All words of a batch: their bytes are data[starts[i]:ends[i]]; those of text t are first[t] to first[t + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64 bits a word, equal for equal words."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + PIECE, "right")))
            low = self.starts[i]
            piece = self.data[low : self.ends[j - 1]]
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(_VALUES[piece] * _power(_BASE, len(piece)), out=sums[1:])
            a, b = self.starts[i:j] - low, self.ends[i:j] - low
            back = _power(_INVERSE, len(piece))
            out[i:j] = (sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            i = j
        return mix(out)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (with the end of the last)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array) -> Words:
    data, at = buffers(texts)
    if not len(data):
        none = np.empty(0, dtype=np.int64)
        return Words(data, none, none, np.zeros(len(at), dtype=np.int64))
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, at))


def shingles(w: Words, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each run of ``length`` words of one text (of all its words where it has fewer), and where texts begin."""
    counts = np.diff(w.first)
    have = np.where(counts == 0, 0, np.maximum(counts - length + 1, 1))
    first = np.concatenate([[0], np.cumsum(have)])
    start = np.repeat(w.first[:-1] - first[:-1], have) + np.arange(first[-1])
    left = np.repeat(w.first[1:], have) - start
    padded = np.concatenate([hashes, np.zeros(length, dtype=np.uint64)])
    total = np.zeros(len(start), dtype=np.uint64)
    for k in range(length):
        total *= np.uint64(0xC2B2AE3D27D4EB4F)
        total += np.where(left > k, padded[start + k], np.uint64(0)) if len(start) else total
    return mix(total), first


def by_size(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one hold some 8 MB at most (or are a single row), to bound memory."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        _, at = buffers(texts)
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(at, at[i] + most, "right")) - 1
            j = min(max(j, i + 1), i + rows, batch.num_rows)
            yield batch.slice(i, j - i)
            i = j
