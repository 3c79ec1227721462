"""Document fingerprints: one-permutation MinHash, in DataFrame functions only.

The runs of five words of a text (all its words where it has fewer) are hashed once. The top bits of a hash choose one
of 256 bins and a bin keeps its least hash. Bins that stay empty borrow from full ones by optimal densification
(Shrivastava, 2017): each tries the bins of a fixed random sequence of its own until one is full; after eight tries it
takes the full bin that is least in a fixed random order. The low eight bits of each bin are stored, packed as
hexadecimal digits, and likeness is the share of equal bins, corrected for those that agree by chance.

Null counts as empty. Texts without words have an empty fingerprint; two of these are alike (1), and one of these and a
text with words are not (0). Equal texts have equal
fingerprints whatever row they stand in. The cost of a text is its length; nothing is exploded into rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
BINS, BITS = 256, 8
TRIES = 8
#: Rows whose ids agree but for the low bits are neighbours in one group, so a group holds 1,024 different ids at most.
NEAR, STEP = 10, 16


def _tries() -> list[Column]:
    """For each try, the bin (from 0) that each bin looks at."""
    rng = random.Random(1009)
    return [F.lit([rng.randrange(BINS) for _ in range(BINS)]) for _ in range(TRIES)]


def with_fingerprint(frame: DataFrame, text: str, out: str) -> DataFrame:
    """``frame`` with the fingerprint of column ``text``: the packed low bits of every bin, empty without words.

    Each step is a projection of its own, so that Spark compiles the sort instead of interpreting it within a lambda.
    """
    h, s, b = "__hashes", "__shingles", "__bins"
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    many = F.transform(
        F.sequence(F.lit(0), F.size(h) - WORDS),
        lambda i: F.xxhash64(*(F.get(F.col(h), i + k) for k in range(WORDS))),
    )
    few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.slice(h, 1, 0))
    # A last hash for each bin makes every bin show up in the sorted hashes; it stands first only where the bin is empty.
    lasts = F.lit([((i - BINS // 2) << (64 - 8)) + _EMPTY for i in range(BINS)])
    frame = frame.withColumn(h, F.transform(words, lambda w: F.xxhash64(w)))
    frame = frame.withColumn(s, F.when(F.size(h) >= WORDS, many).otherwise(few))
    frame = frame.withColumn(s, F.sort_array(F.concat(s, lasts)))
    first = lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(F.col(s), i - 1)))
    frame = frame.withColumn(b, F.filter(s, first))
    return frame.withColumn(out, F.when(F.size(h) > 0, _packed(F.col(b))).otherwise("")).drop(h, s, b)


_EMPTY = (1 << (64 - 8)) - 1


def _bin(h: Column) -> Column:
    """Bins in the order of signed numbers, from -128."""
    return F.shiftright(h, 64 - 8)


def _full(h: Column) -> Column:
    return h.bitwiseAND(F.lit(_EMPTY)) != _EMPTY


def _packed(bins: Column) -> Column:
    tries = _tries()

    def value(i: Column) -> Column:
        seen = [F.get(bins, i), *(F.get(bins, F.get(t, i)) for t in tries)]
        ordered = F.transform(F.filter(bins, _full), lambda x: F.struct(F.xxhash64(i, _bin(x)).alias("order"), x.alias("x")))
        return F.coalesce(*(F.when(_full(x), x) for x in seen), F.array_min(ordered)["x"])

    low = lambda i: F.lpad(F.hex(value(i).bitwiseAND(F.lit((1 << BITS) - 1))), 2, "0")
    return F.lower(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), low), ""))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity behind two fingerprints, from 0 to 1."""
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    equal = F.size(F.filter(bins, lambda i: F.substring(a, 2 * i + 1, F.lit(2)) == F.substring(b, 2 * i + 1, F.lit(2))))
    chance = 2.0**-BITS
    estimate = (equal / F.lit(float(BINS)) - chance) / (1 - chance)
    known = (a != "") & (b != "")
    return F.when(a == b, 1.0).when(known, F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))).otherwise(0.0)


def next_lower(groups: DataFrame, steps: tuple[int, ...] = (STEP, STEP)) -> DataFrame:
    """g and next_g, the next smaller number of ``groups`` (g, all different), and the largest after the smallest.

    Numbers are compared within blocks of 65,536, then blocks within blocks of blocks; what is left for one task is one
    row for each 2**42 ids.
    """
    if not steps:
        order = Window.orderBy(F.desc("g"))
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return groups.select("g", F.coalesce(F.lead("g").over(order), F.max("g").over(whole)).alias("next_g"))
    block = groups.withColumn("block", F.shiftright("g", steps[0]))
    heads = block.groupBy("block").agg(F.max("g").alias("head"))
    after = next_lower(heads.select(F.col("block").alias("g")), steps[1:])
    after = after.join(heads.withColumnRenamed("block", "next_g"), "next_g").select(F.col("g").alias("block"), "head")
    within = block.withColumn("next_g", F.lead("g").over(Window.partitionBy("block").orderBy(F.desc("g"))))
    return within.join(after, "block").select("g", F.coalesce("next_g", "head").alias("next_g"))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next document by descending doc_id (after the last: the first).

    A null id comes last; rows with the same id follow each other by text. Neighbours meet in groups of 1,024 ids; only
    one row a group looks for its neighbour in another group.
    """
    last = F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("bigint"), last)).withColumn("g", F.shiftright("__id", NEAR))
    order = Window.partitionBy("g").orderBy(F.desc("__id"), F.col("text"))
    beside = keyed.withColumn("__after", F.lead(F.struct(*columns)).over(order)).withColumn("__place", F.row_number().over(order))
    chain = next_lower(keyed.select("g").distinct())
    heads = beside.filter("__place = 1").select(F.col("g").alias("next_g"), F.struct(*columns).alias("__head"))
    ends = beside.filter("__after is null").join(chain, "g").join(heads, "next_g")
    kept = [F.col(c) for c in docs.columns]
    inner = beside.filter("__after is not null").select(*kept, *(F.col(f"__after.{c}").alias(f"next_{c}") for c in columns))
    return inner.unionAll(ends.select(*kept, *(F.col(f"__head.{c}").alias(f"next_{c}") for c in columns)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; one row for each row of ``docs``.

    The edited text has the last half (rounded down) of its code points replaced by as many from the start of the next.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    beside = with_next(with_fingerprint(own, "text", "fingerprint"), ["text", "fingerprint"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    beside = beside.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("edited", edited)
    out = with_fingerprint(beside, "edited", "edited_fingerprint")
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
