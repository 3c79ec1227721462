"""Phrases of two to three words that occur together more often than their parts, by Rabin-Karp fingerprints.

1. Texts go into blocks of bounded size, written to the shared folder as compressed binaries, so that a pointer (block
   and number of a word in it) means the same whenever a task is run again.
2. Each block hashes its words and, by prefix polynomials over these hashes, every run of one to three words of a piece.
   Equal fingerprints of a block become one entry: fingerprint, count and the pointer to the first occurrence. All other
   occurrences are compared with that one (word for word, words byte for byte); should two phrases share a fingerprint,
   they become two entries.
3. A shuffle by the upper bits of the fingerprint brings the entries of all blocks together as packed arrays. Fingerprints
   that occur ``least`` times go back to their blocks with their pointers. As sums over fingerprints are never too small,
   no frequent phrase is lost.
4. Blocks turn these pointers into text, and the counts are summed by language and text, which separates phrases of
   different blocks that share a fingerprint. Only what is frequent after this is ever a phrase.
5. Frequent phrases are scored, and those that a longer one covers dropped, by joins on language and text. The first of
   each language are the first among those of its slices.

Lower case, pieces and words: A-Z only; cut at ``[.,;:!?\\x0A-\\x0D]``; words ``[^\\x20\\x09]+``, joined by one space.

Null texts are empty; a null language is ``und``. Empty texts give nothing, empty tables no rows. Repeated rows count each.
Ties of score and count go by phrase in UTF-8 byte order, and of two cuts with equal score the earlier counts. The id of a
document plays no part, nor do other columns. A text is never cut; one larger than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywing.llm.shared import checkpointed
from tallywing.llm.textbytes import Words, buffers, mix

LONGEST = 3
#: Bytes of text in a block, and for each part that the fingerprints are dealt to.
BLOCK = 10 << 20
PART = 16 << 20
#: Slices of a language's phrases, each of which is ranked by itself before its first ones meet.
SLICES = 64
#: Bits of a fingerprint. Any number is right, as all is verified; at 40 bits, of 10^10 phrases one in a hundred shares its
#: fingerprint with another, and is verified for nothing only if both together occur often enough.
BITS = 40

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False

_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Words, entries or phrases worked on at a time, so that temporary arrays stay small beside a block or part.
_STEP = 1 << 18


class Block:
    """The words of some texts: bytes, where each begins and ends, and its piece and language (32 bits each where they do)."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, at = buffers(texts)
        data = _LOWER[data]
        kind = np.int32 if len(data) < 1 << 30 else np.int64
        inside = _INSIDE[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[at] = True
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        self.data = data
        self.starts = np.flatnonzero(begins).astype(kind)
        self.ends = (np.flatnonzero(stops) + 1).astype(kind)
        del inside, edge, begins, stops
        breaks = np.flatnonzero(_BREAK[data]).astype(kind)
        names = langs.fill_null("und").dictionary_encode()
        self.names = names.dictionary.to_pylist()
        lang = names.indices.to_numpy(zero_copy_only=False)
        self.piece, self.lang = np.empty(len(self.starts), dtype=kind), np.empty(len(self.starts), dtype=np.int32)
        for i, j in _steps(len(self.starts)):
            text = np.searchsorted(at, self.starts[i:j], "right") - 1
            self.piece[i:j] = np.searchsorted(breaks, self.starts[i:j]) + text
            self.lang[i:j] = lang[text]

    def identities(self, hashes: np.ndarray) -> np.ndarray:
        """A number for each word, equal just where the bytes are."""
        known, first = _first_of_each(hashes)
        which = np.empty(len(hashes), dtype=np.int32 if len(hashes) < 1 << 31 else np.int64)
        size = self.ends - self.starts
        wrong = np.zeros(len(hashes), dtype=bool)
        for i, j in _steps(len(hashes)):
            which[i:j] = np.searchsorted(known, hashes[i:j])
            wrong[i:j] = size[i:j] != size[first[which[i:j]]]
            at, k = np.arange(i, j), 0
            while len(at):
                one, other = self.starts[at] + k, self.starts[first[which[at]]] + k
                rest = np.minimum(size[at] - k, 8)
                differs = np.zeros(len(at), dtype=bool)
                for b in range(8):  # beyond the last byte there is nothing to compare, whatever is taken there
                    differs |= (self.data.take(one + b, mode="clip") != self.data.take(other + b, mode="clip")) & (b < rest)
                wrong[at] |= differs
                k += 8
                at = at[size[at] > k]
        if wrong.any():  # two words of one hash: number all words by their bytes
            raw, seen = self.data.tobytes(), {}
            return np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(self.starts, self.ends, strict=True)])
        return which

    def entries(self, words: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints in ascending order, how often each occurs, and the first word of the first occurrence."""
        return tuple(np.concatenate(x) for x in zip(*self.ranges(words, hashes, n), strict=True))

    def ranges(self, words: np.ndarray, hashes: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The entries by ranges of fingerprints, one sorted at a time."""
        size = max(len(words) - n + 1, 0)
        bits = min((size // _STEP).bit_length(), 7)
        salts = _lang_hashes(self.names)
        prints, which = np.zeros(size, dtype=np.uint64), np.full(size, 255, dtype=np.uint8)
        for i, j in _steps(size):
            at = i + np.flatnonzero(self.piece[i:j] == self.piece[i + n - 1 : j + n - 1])
            prints[at] = fingerprints(hashes, at, n, salts[self.lang[at]])
            which[at] = prints[at] >> np.uint64(BITS - bits)
        for r in range(1 << bits):
            at = np.flatnonzero(which == r)
            yield self._sorted(words, n, prints[at], at)

    def _sorted(self, words: np.ndarray, n: int, prints: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(prints, kind="stable")
        prints, at = prints[order], at[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = prints[1:] != prints[:-1]
        same = ~new[1:]
        each = (words[at + j] if j < n else self.lang[at] for j in range(n + 1))
        if any((same & (p[1:] != p[:-1])).any() for p in each):  # two phrases of one fingerprint
            parts = [*(words[at + j] for j in range(n)), self.lang[at]]
            order = np.lexsort([at, *parts, prints])
            prints, at, parts = prints[order], at[order], [p[order] for p in parts]
            new[1:] = prints[1:] != prints[:-1]
            for p in parts:
                new[1:] |= p[1:] != p[:-1]
        begin = np.flatnonzero(new)
        return prints[begin], np.diff(np.append(begin, len(at))), at[begin]


def _steps(n: int) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of ``_STEP`` of ``n``."""
    return ((i, min(i + _STEP, n)) for i in range(0, n, _STEP))


def _first_of_each(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order, and where each occurs first."""
    known, first = [hashes[:0]], [np.empty(0, dtype=np.int64)]
    for i, j in _steps(len(hashes)):
        own, at = np.unique(hashes[i:j], return_index=True)
        known.append(own)
        first.append(at + i)
    distinct, at = np.unique(np.concatenate(known), return_index=True)
    return distinct, np.concatenate(first)[at]


def _lang_hashes(names: list[str]) -> np.ndarray:
    """64 bits a language, from its bytes."""
    flat, at = buffers(pa.array([f"{name}\0" for name in names], pa.string()))
    return Words(flat, at[:-1], at[1:], at).hashes()


def fingerprints(hashes: np.ndarray, at: np.ndarray, n: int, salt: np.ndarray) -> np.ndarray:
    """A polynomial of the hashes of words ``at`` to ``at + n - 1``, from differences of its prefix sums modulo 2**64."""
    out = np.empty(len(at), dtype=np.uint64)
    powers = _powers(_BASE, _STEP + LONGEST)
    inverse = _powers(_INVERSE, _STEP + LONGEST)
    for low in range(int(at[0]), int(at[-1]) + 1, _STEP) if len(at) else ():
        i, j = np.searchsorted(at, [low, low + _STEP])
        piece = hashes[low : min(low + _STEP, int(at[-1]) + 1) + n]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(piece * powers[: len(piece)], out=sums[1:])
        own = at[i:j] - low
        out[i:j] = mix((sums[own + n] - sums[own]) * inverse[own] + salt[i:j] * np.uint64(2 * n + 1)) >> np.uint64(64 - BITS)
    return out


_known: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _known:
        powers = np.full(n, base, dtype=np.uint64)
        powers[0] = 1
        _known[base] = np.multiply.accumulate(powers)
    return _known[base]


def _packed(*columns: np.ndarray) -> bytes:
    """Arrays of equal length, byte by byte and compressed, as most of their upper bytes are zero."""
    wide = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    raw = b"".join(w.tobytes() for w in wide)
    return len(columns[0]).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(raw: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(raw[:8], "little")
    flat = np.frombuffer(pa.decompress(raw[8:], n * 8 * columns, "zstd", asbytes=True), dtype=np.uint8)
    return [np.ascontiguousarray(c.T).view("<u8").ravel() for c in flat.reshape(columns, 8, n)]


def _written(texts: list[pa.Array], langs: list[pa.Array]) -> bytes:
    table = pa.table({"text": pa.chunked_array(texts, pa.large_string()), "lang": pa.chunked_array(langs, pa.string())})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as writer:
        writer.write_table(table.combine_chunks())
    return out.getvalue().to_pybytes()


def _block(raw: bytes) -> Block:
    table = pa.ipc.open_stream(raw).read_all().combine_chunks()
    if not table.num_rows:
        return Block(pa.array([], pa.large_string()), pa.array([], pa.string()))
    return Block(*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (table["text"], table["lang"])))


def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """``block`` and ``content`` (texts and languages) of some ``size`` bytes of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        texts, langs, held = [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_written(texts, langs)], pa.binary())], ["block", "content"])

        for b in batches:
            text, lang = b.column(0).fill_null("").cast(pa.large_string()), b.column(1).cast(pa.string())
            _, at = buffers(text)
            i = 0
            while i < b.num_rows:
                j = int(np.searchsorted(at, at[i] + size - held, "right")) - 1
                j = min(max(j, i + (not held)), b.num_rows)
                if j > i:
                    texts.append(text.slice(i, j - i))
                    langs.append(lang.slice(i, j - i))
                    held += int(at[j] - at[i])
                if j < b.num_rows:
                    yield out()
                    number, texts, langs, held = number + 1, [], [], 0
                i = j
        if texts:
            yield out()

    return docs.select("text", "lang").mapInArrow(run, "block bigint, content binary")


def _hashed(block: Block) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.empty(len(block.starts), dtype=np.uint64)
    for i, j in _steps(len(hashes)):
        hashes[i:j] = Words(block.data, block.starts[i:j], block.ends[i:j], block.starts[:0]).hashes()
    return block.identities(hashes), hashes


def _entries(parts: int):
    """The fingerprints of a block, dealt to ``parts``: rows of part, block and packed arrays for each length."""

    def dealt(number: int, block: Block) -> Iterator[pa.RecordBatch]:
        words, hashes = _hashed(block)
        for n in range(1, LONGEST + 1):
            for prints, counts, first in block.ranges(words, hashes, n):
                part = (prints >> np.uint64(BITS - 32)) * np.uint64(parts) >> np.uint64(32)
                cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]), len(part))
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    row = [int(part[i]), number, n, _packed(np.diff(prints[i:j], prepend=np.uint64(0)), counts[i:j], first[i:j])]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["part", "block", "n", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield from dealt(number, _block(raw.as_py()))

    return run


def _frequent(least: int):
    """Of the entries of one part, those whose fingerprints occur ``least`` times, packed for their blocks again."""

    def run(part: pa.Table) -> pa.Table:
        prints, counts = [], []
        for raw in part["entries"]:
            steps, count, _ = _unpacked(raw.as_py(), 3)
            prints.append(np.cumsum(steps, dtype=np.uint64))
            counts.append(count.astype(np.uint32))
        often = [np.empty(len(p), dtype=bool) for p in prints]
        # Rows are sorted, so a range of fingerprints is a slice of each; one range is brought together at a time.
        least_print, most_print = min(int(p[0]) for p in prints), max(int(p[-1]) for p in prints)
        ranges = sum(map(len, prints)) // _STEP + 1
        edges = np.linspace(least_print, most_print + 1, ranges + 1).astype(np.uint64)
        cuts = [np.searchsorted(p, edges) for p in prints]
        for r in range(ranges):
            own = [slice(c[r], c[r + 1]) for c in cuts]
            enough = _enough(np.concatenate([p[s] for p, s in zip(prints, own, strict=True)]), np.concatenate([c[s] for c, s in zip(counts, own, strict=True)]), least)
            low = 0
            for o, s in zip(often, own, strict=True):
                o[s] = enough[low : low + s.stop - s.start]
                low += s.stop - s.start
        rows = {"block": [], "n": [], "wanted": []}
        for block, n, raw, own in zip(part["block"].to_pylist(), part["n"].to_pylist(), part["entries"], often, strict=True):
            if own.any():
                _, count, first = _unpacked(raw.as_py(), 3)
                rows["block"].append(block)
                rows["n"].append(n)
                rows["wanted"].append(_packed(first[own], count[own]))
        return pa.table(rows, schema=pa.schema([("block", pa.int64()), ("n", pa.int32()), ("wanted", pa.binary())]))

    return run


def _enough(prints: np.ndarray, counts: np.ndarray, least: int) -> np.ndarray:
    """Whether the fingerprint at each place occurs ``least`` times over all places."""
    # Lengths have fingerprints of their own, but for chance; that only lets a few more back.
    order = np.argsort(prints, kind="stable")
    begin = np.flatnonzero(np.append(True, prints[order][1:] != prints[order][:-1])[: len(prints)])
    total = np.add.reduceat(counts[order], begin, dtype=np.int64)
    out = np.empty(len(prints), dtype=bool)
    out[order] = np.repeat(total >= least, np.diff(np.append(begin, len(prints))))
    return out


def _phrases(own: pa.Table, wanted: pa.Table) -> pa.Table:
    """The phrases of a block that pointers name, with their counts; without a phrase, the words of each language."""
    schema = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("count", pa.int64())])
    ns, firsts, counts = [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.empty(0, np.uint32)]
    for n, packed in zip(wanted["n"].to_pylist(), wanted["wanted"], strict=True):
        first, count = _unpacked(packed.as_py(), 2)
        ns.append(np.full(len(first), n, dtype=np.int32))
        firsts.append(first.astype(np.int32))
        counts.append(count.astype(np.uint32))
    ns, firsts, counts = np.concatenate(ns), np.concatenate(firsts), np.concatenate(counts)
    out = []
    for raw in own["content"]:
        block = _block(raw.as_py())
        total = [(name, count) for name, count in zip(block.names, np.bincount(block.lang, minlength=len(block.names)).tolist(), strict=True) if count]
        out.append(pa.table([[x for x, _ in total], [0] * len(total), [None] * len(total), [x for _, x in total]], schema=schema))
        data, names = block.data.tobytes(), pa.array(block.names, pa.string())
        for i, j in _steps(len(firsts)):
            first, n = firsts[i:j], ns[i:j]
            spans = zip(block.starts[first].tolist(), block.ends[first + n - 1].tolist(), strict=True)
            phrase = pa.array([b" ".join(data[x:y].split()) for x, y in spans], pa.binary()).cast(pa.string())
            out.append(pa.table([names.take(pa.array(block.lang[first])), pa.array(n), phrase, pa.array(counts[i:j].astype(np.int64))], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def phrase_counts(docs: DataFrame, least: int = 10, block: int = BLOCK, part: int = PART) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``f`` of every run of one to three words that occurs ``least`` times in its
    language, and with 0 ``words`` and a null phrase, how many words the language has."""
    written = checkpointed(blocks(docs, block))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // part + 1
    entries = written.mapInArrow(_entries(parts), "part bigint, block bigint, n int, entries binary")
    wanted = entries.groupBy("part").applyInArrow(_frequent(least), "block bigint, n int, wanted binary")
    told = written.groupBy("block").cogroup(wanted.groupBy("block"))
    found = told.applyInArrow(_phrases, "lang string, words int, phrase string, count bigint")
    counts = found.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("f"))
    return checkpointed(counts.filter((F.col("f") >= least) | (F.col("words") == 0)))


def scored(counts: DataFrame, covered: int = 50) -> DataFrame:
    """Candidates with the parts and score of their lowest-scoring cut, without those that a longer one covers."""
    phrases = counts.filter("words > 0")
    c = phrases.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def cut(k: int):
        return F.struct(F.lit(k).alias("k"), *(F.array_join(x, " ").alias(name) for x, name in ((F.slice("w", 1, k), "head"), (F.slice("w", k + 1, LONGEST), "tail"))))

    longest = F.array(*(cut(k) for k in range(1, LONGEST)))
    cuts = c.select("lang", "phrase", "a", F.explode(F.slice(longest, F.lit(1), F.col("words") - 1)).alias("cut")).select("lang", "phrase", "a", "cut.*")
    for side, name in (("head", "l"), ("tail", "r")):
        of = phrases.select(F.col("lang").alias("its"), F.col("phrase").alias("part"), F.col("f").alias(name))
        cuts = cuts.join(of, (F.col("lang") == F.col("its")) & (F.col(side) == F.col("part"))).drop("its", "part")
    wide = {x: F.col(x).cast("decimal(15,0)") for x in "alr"}
    # 10^6 a^2 has 36 digits where a has 15; div of whole decimals is exact.
    parts = cuts.withColumn("over", (wide["a"] * wide["a"] * F.lit(1000000).cast("decimal(7,0)")).cast("decimal(38,0)"))
    parts = parts.withColumn("under", (wide["l"] * wide["r"]).cast("decimal(38,0)")).withColumn("score", F.expr("over div under"))
    best = parts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.*")
    inner = F.array(*(F.array_join(F.slice("w", i, 2), " ") for i in range(1, LONGEST)))
    longer = c.filter(f"words = {LONGEST}").select("lang", F.explode(inner).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {covered} * a")
    return left.select("lang", "phrase", "a", "l", "r", "score")


def ranked(phrases: DataFrame, most: int = 2000) -> DataFrame:
    """The first ``most`` phrases of each language with their ``rank``.

    No task sees all phrases of a language: the first of each of its slices are found before, and only these ranked.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = phrases.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    place = F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    first = dealt.withColumn("place", place).filter(F.col("place") <= most).drop("slice", "place")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return first.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= most)


def collocations(docs: DataFrame, least: int = 10, covered: int = 50, most: int = 2000, block: int = BLOCK, part: int = PART) -> DataFrame:
    """The first ``most`` phrases of each language: lang, rank, phrase, a, l, r, n and score."""
    counts = phrase_counts(docs, least, block, part)
    n = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked(scored(counts, covered), most).join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
