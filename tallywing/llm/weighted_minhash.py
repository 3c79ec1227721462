"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A text is the set of its runs of five words (all its words where it has fewer), each weighted by its count in the text
times ``1 + ln((1 + N) / (1 + df))``. The document frequency df is counted over all documents for 2**14 classes of
shingle hashes, as feature hashing does, so the table has a fixed size at any scale; a rare shingle thereby counts as
frequent as its class, and two texts that share rare shingles are not set apart by weights.

1. Improved consistent weighted sampling (Ioffe, 2010) draws 48 samples a text; two texts agree in one with the
   probability of their weighted Jaccard similarity. 16 bands of 3 samples make candidates: at a similarity of 0.8 all
   bands fail with a probability of 1e-5.
2. Equal texts are one from here on, by a digest. In each band's group, every text is a candidate with three pivots
   (linear in the group); those whose samples agree in less than half are set aside (at 0.8: a chance of 1e-6), and the
   rest is verified exactly on the whole texts.
3. Links form components. Where the texts of a group are then still in several components, an exact prefix filter finds
   what is left: texts that are alike share an element of their rarest ones, and what follows it weighs enough in both.
   Texts that meet so are compared in rounds with a few pivots each; most have too many words of their own to meet any.
   A round has one row for each text and pivot that may be alike, and texts of one component are not compared.

Null texts and texts without words are alike to nothing: each is a class of its own. A null id is given a class of its
own too (null). Repeated rows under one id share a class; an id with several texts is alike to what any of them is alike to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywing.llm.components import components
from tallywing.llm.shared import checkpointed, in_few
from tallywing.llm.textbytes import by_size, mix, shingles, words

WORDS = 5
CLASS_BITS = 14
BANDS, ROWS = 16, 3
SAMPLES = BANDS * ROWS
LEVELS = 1 << 16
#: Sums of weights in different order must not decide a tie at the threshold.
ROUNDING = 1 + 1e-6


def _gamma_quantiles() -> np.ndarray:
    """Of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x)."""
    x = np.concatenate([np.geomspace(1e-6, 1, 20000), np.linspace(1, 40, 60000)[1:]])
    return np.interp((np.arange(LEVELS) + 0.5) / LEVELS, 1 - (1 + x) * np.exp(-x), x)


_GAMMA = _gamma_quantiles().astype(np.float32)
_LN_GAMMA = np.log(_GAMMA)
_FACTORS = (np.random.default_rng(71).integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1))[:, None]


def _texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = words(texts)
    return shingles(w, w.hashes(), WORDS)


def _classes(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CLASS_BITS)).astype(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The weight of each of the 2**14 classes: a table of fixed size, counted over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(1 << CLASS_BITS, dtype=np.int64), 0
        for b in by_size(batches, most=4 << 20):
            h, first = _texts(b.column(0))
            for i, j in zip(first[:-1], first[1:], strict=True):
                if j > i:
                    seen[np.unique(_classes(h[i:j]))] += 1
                    total += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*at, -1], pa.int32()), pa.array([*seen[at], total], pa.int64())], ["class", "n"])

    counted = docs.select("text").mapInArrow(count, "class int, n bigint").groupBy("class").agg(F.sum("n").alias("n"))
    n = {r["class"]: r["n"] for r in counted.collect()}  # 2**14 + 1 rows at most
    df = np.array([n.get(k, 0) for k in range(1 << CLASS_BITS)], dtype=np.float64)
    return (1 + np.log((1 + n.get(-1, 0)) / (1 + df))).astype(np.float32)


def sample(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """48 consistent samples of a weighted set, each as a number that stands for its element and quantised weight."""
    best, chosen = np.full(SAMPLES, np.inf, dtype=np.float32), np.zeros(SAMPLES, dtype=np.uint64)
    rows = np.arange(SAMPLES)
    for i in range(0, len(hashes), 2048):
        h, ln = hashes[i : i + 2048], np.log(weights[i : i + 2048])
        x = h[None, :] * _FACTORS
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        r = _GAMMA[x & np.uint64(0xFFFF)]
        score = _LN_GAMMA[(x >> np.uint64(16)) & np.uint64(0xFFFF)]
        beta = (x >> np.uint64(40)).astype(np.float32)
        beta *= np.float32(2.0**-24)
        t = ln[None, :] / r
        t += beta
        np.floor(t, out=t)
        beta -= t
        beta -= 1
        beta *= r
        score += beta  # ln c - r (t - beta + 1)
        at = np.argmin(score, axis=1)
        least = score[rows, at]
        better = least < best
        best[better] = least[better]
        step = t[rows, at].astype(np.int64).astype(np.uint64)
        chosen[better] = mix(h[at] ^ mix(step + np.uint64(1)))[better]
    return chosen


def sketches(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """doc_id, digest, bands and signature of every text that has words."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, most=4 << 20):
            h, first = _texts(b.column(1))
            kept = np.flatnonzero(np.diff(first))
            samples = np.empty((len(kept), SAMPLES), dtype=np.uint64)
            for k, d in enumerate(kept):
                own, times = np.unique(h[first[d] : first[d + 1]], return_counts=True)
                samples[k] = sample(own, times.astype(np.float32) * weight[_classes(own)])
            keys = np.zeros((len(kept), BANDS), dtype=np.uint64)
            for r in range(ROWS):
                keys = mix(keys + samples[:, r::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
            low = (samples & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
            columns = [b.column(0).take(pa.array(kept)), b.column(2).take(pa.array(kept))]
            columns.append(pa.ListArray.from_arrays(np.arange(len(kept) + 1, dtype=np.int32) * BANDS, keys.view(np.int64).ravel()))
            columns.append(pa.ListArray.from_arrays(np.arange(len(kept) + 1, dtype=np.int32) * SAMPLES, low.ravel()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "bands", "signature"])

    rows = docs.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    return rows.mapInArrow(draw, "doc_id bigint, digest binary, bands array<bigint>, signature array<smallint>")


def weighted_jaccard(a: pa.Array, b: pa.Array, weight: np.ndarray) -> np.ndarray:
    """Of a[i] and b[i], over whole texts; 0 where both are empty."""
    hashes, pair, side = [], [], []
    for k, texts in enumerate((a, b)):
        h, first = _texts(texts)
        hashes.append(h)
        pair.append(np.repeat(np.arange(len(texts)), np.diff(first)))
        side.append(np.full(len(h), k, dtype=np.int8))
    h, pair, side = map(np.concatenate, (hashes, pair, side))
    order = np.lexsort((h, pair))
    h, pair, side = h[order], pair[order], side[order]
    if not len(h):
        return np.zeros(len(a))
    new = np.append(True, (h[1:] != h[:-1]) | (pair[1:] != pair[:-1]))
    at = np.flatnonzero(new)
    right = np.add.reduceat(side.astype(np.int64), at)
    left = np.diff(np.append(at, len(h))) - right
    value = weight[_classes(h[at])].astype(np.float64)
    shared = np.bincount(pair[at], np.minimum(left, right) * value, len(a))
    either = np.bincount(pair[at], np.maximum(left, right) * value, len(a))
    return np.divide(shared, either, out=np.zeros(len(a)), where=either > 0)


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and text of the ids, each different text of an id once, however many rows repeat it."""
    return docs.join(ids.distinct(), "doc_id", "left_semi").select("doc_id", "text").distinct()


def _verify(pairs: DataFrame, docs: DataFrame, weight: np.ndarray, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "text_a", most=2 << 20, rows=500):
            found = weighted_jaccard(b.column(2), b.column(3), weight) + 1e-12 >= threshold
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(found)) for k in (0, 1)], ["a", "b"])

    once = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs)
    left = once.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = once.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    texts = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return texts.mapInArrow(alike, "a bigint, b bigint").distinct()


def _elements(texts: DataFrame, weight: np.ndarray) -> DataFrame:
    """doc_id, key, total, element and mass: a row for each element of each text.

    A shingle that a text has t times is t elements, so that the least count of two texts is what they share.
    """

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, most=1 << 20):
            h, first = _texts(b.column(2))
            text = np.repeat(np.arange(b.num_rows), np.diff(first))
            order = np.lexsort((h, text))
            h, text = h[order], text[order]
            at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
            time = np.arange(len(h)) - np.repeat(at, np.diff(np.append(at, len(h))))
            mass = weight[_classes(h)]
            element = mix(h + time.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            total = np.bincount(text, mass.astype(np.float64), b.num_rows)
            lists = [pa.ListArray.from_arrays(first.astype(np.int32), pa.array(x)) for x in (element, mass)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(total), *lists], ["doc_id", "key", "total", "element", "mass"])

    keyed = texts.select("doc_id", F.xxhash64("text").alias("key"), "text")
    lists = keyed.mapInArrow(take, "doc_id bigint, key bigint, total double, element array<bigint>, mass array<float>")
    one = lists.select("doc_id", "key", "total", F.explode(F.arrays_zip("element", "mass")).alias("e"))
    return one.select("doc_id", "key", "total", "e.element", "e.mass")


def _prefixes(elements: DataFrame, threshold: float) -> DataFrame:
    """element, df, doc_id, key, total and rest: the elements by which a text may first meet one that is alike to it.

    All elements are ordered by the texts they are in, rarest first. ``rest`` is the weight of what the text shares with
    any other from the element on. Two texts share no more than the lesser ``rest`` at their first common element, and
    texts that are alike share ``threshold`` times the weight of either. So an element with less than that behind it is
    not the first of such a pair, and a text whose own words weigh too much has no row at all.
    """
    common = elements.groupBy("element").agg(F.count("*").alias("df")).filter("df > 1")
    lists = elements.join(common, "element").groupBy("doc_id", "key", "total").agg(F.collect_list(F.struct("df", "element", "mass")).alias("e"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, sizes = b.column(3).flatten(), b.column(3).value_lengths().to_numpy(zero_copy_only=False)
            df, element, mass = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            text = np.repeat(np.arange(b.num_rows), sizes)
            order = np.lexsort((element, df, text))
            df, element, mass = df[order], element[order], mass[order].astype(np.float64)
            before = np.cumsum(mass) - mass
            ends = np.append(before, before[-1] + mass[-1])[np.cumsum(sizes)]
            rest = ends[text] - before
            total = b.column(2).to_numpy()
            keep = np.flatnonzero(rest * ROUNDING >= threshold * total[text])
            ids = [b.column(k).take(pa.array(text[keep])) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(element[keep]), pa.array(df[keep]), *ids, pa.array(total[text[keep]]), pa.array(rest[keep])],
                ["element", "df", "doc_id", "key", "total", "rest"],
            )

    return lists.select("doc_id", "key", "total", "e").mapInArrow(
        cut, "element bigint, df bigint, doc_id bigint, key bigint, total double, rest double"
    )


def _of_different_texts(places: DataFrame) -> DataFrame:
    """``places`` without elements that are in one text, or in the same texts as one before them in order."""
    sums = [F.sum(F.xxhash64(F.lit(k), "doc_id", "key").cast("decimal(20,0)")).alias(f"s{k}") for k in (0, 1)]  # 128 bits tell sets apart
    sets = places.groupBy("element").agg(F.first("df").alias("df"), *sums, F.count("*").alias("c"))
    kept = sets.filter("c > 1").groupBy("s0", "s1", "c").agg(F.min_by("element", F.struct("df", "element")).alias("element"))
    return places.join(kept.select("element"), "element")


def _across(rows: DataFrame, label: DataFrame, docs: DataFrame, weight: np.ndarray, threshold: float) -> DataFrame:
    """node and component after all links between the components of a band's group, where a group is still in several.

    ``rows`` has band, doc_id and n (texts of the group). Groups below four texts are done: their pivots are all pairs.
    Texts of open groups meet by the elements of their prefixes, whatever their band. In a round, the texts of an element
    are compared with some pivots of other components among them: first with the one that has most in common with
    others, then with some 64, 4096, ... by a hash, until the element's texts are one component or all have been pivots.
    A text without a pivot that the bound allows is not compared.
    """
    parts = _labelled(rows.filter("n > 3"), label).groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    ids = rows.join(parts.filter("x < y").select("band"), "band").select("doc_id")
    texts = checkpointed(_texts_of(ids, docs))
    places = checkpointed(_of_different_texts(checkpointed(_prefixes(_elements(texts, weight), threshold))))
    size = places.count()
    places = in_few(places, size)
    least = threshold / (1 + threshold) / ROUNDING
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "key"), 11) * F.lit(2.0**-53)
    tested, pivots_each = None, 0
    while True:
        places = _labelled(places.select("element", "doc_id", "key", "total", "rest"), label)
        as_pivot = F.struct(*[F.col(c).alias(f"p_{c}") for c in ("doc_id", "total", "rest", "component")])
        open_parts = places.groupBy("element").agg(
            F.min("component").alias("x"),
            F.max("component").alias("y"),
            F.count("*").alias("n"),
            F.max_by(as_pivot, F.struct(F.col("rest") / F.col("total"), "doc_id", "key")).alias("pivot"),
        )
        open_parts = checkpointed(in_few(open_parts.filter("x < y"), size))
        largest = open_parts.agg(F.max("n")).first()[0]
        if largest is None:
            return label
        places = checkpointed(in_few(places.join(open_parts.select("element", "n"), "element"), size))
        if pivots_each == 0:
            pivots, pivots_each = open_parts.select("element", "pivot.*"), 1
        else:
            upto = pivots_each * 64
            start = F.lit(0.0) if pivots_each == 1 else pivots_each / F.col("n")
            pivots = places.filter((place >= start) & (place < upto / F.col("n"))).select("element", as_pivot.alias("pivot"))
            pivots, pivots_each = pivots.select("element", "pivot.*"), upto
        meeting = places.drop("n").join(pivots, "element").filter("component <> p_component")
        meeting = meeting.filter(F.least("rest", "p_rest") >= least * (F.col("total") + F.col("p_total")))
        pairs = meeting.select(F.least("doc_id", "p_doc_id").alias("a"), F.greatest("doc_id", "p_doc_id").alias("b")).distinct()
        pairs = checkpointed(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = pairs.count()
        if found:
            pairs = in_few(pairs, found, 1 << 12)
            tested = pairs if tested is None else tested.unionAll(pairs)
            links = checkpointed(_verify(pairs, texts, weight, threshold))
            if links.limit(1).count():
                label = components(links, label)
        if pivots_each >= largest and pivots_each > 1:
            return label


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """``rows`` with the component of doc_id, which is itself where it has no link."""
    joined = rows.join(label, F.col("doc_id") == F.col("node"), "left")
    return joined.select(*rows.columns, F.coalesce("component", "doc_id").alias("component"))


def _likely(pairs: DataFrame, sketch: DataFrame, least: int = SAMPLES // 2) -> DataFrame:
    """The pairs whose signatures agree in at least ``least`` samples."""
    left = sketch.select(F.col("doc_id").alias("a"), F.col("signature").alias("left"))
    right = sketch.select(F.col("doc_id").alias("b"), F.col("signature").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(_agreement("left", "right") >= least).select("a", "b")


def _agreement(left, right):
    return F.size(F.filter(F.zip_with(left, right, lambda x, y: x == y), lambda x: x))


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id and class_id (the smallest id of its class) of every row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    known = texts.filter("doc_id is not null and text is not null")
    weight = inverse_frequencies(known)
    drawn = checkpointed(sketches(known, weight))
    # Written out, so that the join below has a shuffle of its own, whose large partitions (many copies) Spark can split.
    first = checkpointed(drawn.groupBy("digest").agg(F.min("doc_id").alias("text_id")))
    members = drawn.select("doc_id", "digest").join(first, "digest").select("doc_id", "text_id")
    sketch = drawn.join(first.select(F.col("text_id").alias("doc_id"), "digest"), ["doc_id", "digest"])
    sketch = checkpointed(sketch.dropDuplicates(["doc_id", "digest"]))
    rows = sketch.select("doc_id", F.explode("bands").alias("band"))
    groups = rows.groupBy("band").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.min(F.xxhash64("doc_id")).alias("h")
    )
    groups = groups.filter("n > 1")
    near = rows.join(groups, "band")
    third = near.filter(F.xxhash64("doc_id") == F.col("h")).select("band", F.col("doc_id").alias("z"))
    pivots = near.join(third, "band").select("doc_id", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("pivot"))
    ordered = lambda p, q: p.select(F.least(*q).alias("a"), F.greatest(*q).alias("b")).filter("a < b").distinct()
    tested = checkpointed(_likely(ordered(pivots, ("doc_id", "pivot")), sketch))
    links = checkpointed(_verify(tested, known, weight, threshold))
    label = components(links)

    label = _across(near.select("band", "doc_id", "n"), label, known, weight, threshold)
    classes = members.join(label, F.col("text_id") == F.col("node"), "left")
    classes = classes.groupBy("doc_id").agg(F.min(F.coalesce("component", "text_id")).alias("class_id"))
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(classes, "doc_id", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def first_of_each_class(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One document of each class stays: the one with the smallest id, and of its rows the first by a hash of all columns.

    Different texts under one id are documents of their own here, told apart by 64 bits. Rows without an id stay.
    """
    with_id = docs.filter("doc_id is not null")
    hashed = F.xxhash64("text")
    several = with_id.groupBy("doc_id").agg(F.min(hashed).alias("x"), F.max(hashed).alias("y")).filter("x <> y")
    several = checkpointed(several.select(F.col("doc_id").alias("__id")))
    node = F.col("doc_id").cast("bigint")
    if several.limit(1).count():  # else no text has to move for this
        with_id = with_id.join(several, F.col("doc_id") == F.col("__id"), "left")
        node = F.when(F.col("__id").isNull(), node).otherwise(F.xxhash64("doc_id", "text"))
    nodes = with_id.withColumn("__node", node)
    near = near_duplicates(nodes.select(F.col("__node").alias("doc_id"), "text"), threshold).distinct()
    ids = nodes.select("__node", "doc_id").distinct().join(near.withColumnRenamed("doc_id", "__node"), "__node")
    kept = ids.groupBy("class_id").agg(F.min_by("__node", F.struct("doc_id", "__node")).alias("__node")).select("__node")
    order = Window.partitionBy("__node").orderBy(F.xxhash64(*docs.columns))
    first = nodes.join(kept, "__node", "left_semi").withColumn("__row", F.row_number().over(order)).filter("__row = 1")
    return first.select(*docs.columns).unionByName(docs.filter("doc_id is null"))
