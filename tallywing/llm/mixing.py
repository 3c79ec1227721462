"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Sources, by code point and with null last, weigh 1, 2, 3, repeating. Together they get as many words as there are;
a source gets three times its own words at most, and the excess goes to the others by weight.

1. A source's documents fall into about sqrt(n) blocks by a hash of the row (id, text and number among equal ones), or into more where these would hold more
   than 1,024 documents: no window sees a hot source whole.
2. Blocks are put in a random order. A source's quota of words is so many full rounds over its blocks and a last round
   that stops at the exact word: blocks before the stop are drawn whole, the one at the stop by documents in random
   order, and the last of these in part. This gives each source an exact number of block slots.
3. The slots of all sources are split among the output shards by a binary tree: each node deals its slots to two halves
   of equal size, drawing from the multivariate hypergeometric distribution, one source after the other. The leaves say
   how many slots of each source every shard gets, exactly; a source's slots are then dealt in order, so shards hold
   disjoint slots. What a document is taken for is the sum of its dealt slots. Shards are at least 16 and have 64 slots
   or so at most, so that a shard does not grow with the corpus.
4. Each shard is shuffled by itself (``deal``); ``mixed_documents`` gives the texts in that layout.

All randomness is a hash of rows and the seed, so reruns agree. What the tree gathers in one row has a number for each
source and shard, so it grows with the slots (64 a shard), not with texts. Null or empty texts have no words and are dealt
no words. Repeated rows are documents of their own: they are counted and numbered, so that not even equal rows of one id
share a block. A null id is hashed as such. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywing.llm.shared import checkpointed

WEIGHTS = 3
MOST = 3
SHARDS = 16  # at least
SLOTS = 64  # of a shard
BLOCK = 1024  # documents


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """Adds weight and target to one row a source (source, source_size, ...).

    By ascending limit for each unit of weight, a source is held at its limit while that is below an equal share of what
    the sources from it on still get; the first that is not fixes the share of all that follow.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    frame = sizes.withColumn("weight", ((place - 1) % WEIGHTS + 1).cast("double"))
    frame = frame.withColumn("limit", F.lit(float(MOST)) * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    frame = frame.withColumn("share", total / weight)
    free = F.col("limit") >= F.col("share") * F.col("weight")
    share = F.first(F.when(free, F.col("share")), ignorenulls=True).over(whole)
    return frame.withColumn("target", F.least("limit", F.coalesce(share * F.col("weight"), F.col("limit")))).drop("share", "limit")


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) * 2.0**-53


def _let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(good: Column, all_: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``all_`` are among the ``good``, by inversion at ``u``.

    Weights are worked out from the mode outwards, over 12 standard deviations and 12 more; what lies beyond is below
    the resolution of a double.
    """
    d = {"good": good, "all": all_, "drawn": drawn, "u": u}
    inputs = F.struct(*(v.cast("double").alias(k) for k, v in d.items()))

    def invert(x: Column) -> Column:
        k_, n_, m_ = x["good"], x["all"], x["drawn"]
        mode = F.floor((m_ + 1) * (k_ + 1) / (n_ + 2))
        spread = F.sqrt(F.greatest(F.lit(0.0), m_ * k_ / n_ * (1 - k_ / n_) * (n_ - m_) / F.greatest(n_ - 1, F.lit(1.0))))
        reach = F.ceil(12 * spread + 12)
        low = F.greatest(F.lit(0).cast("bigint"), (m_ + k_ - n_).cast("bigint"), mode - reach)
        high = F.least(m_.cast("bigint"), k_.cast("bigint"), mode + reach)
        up = lambda k: (k_ - k) * (m_ - k) / ((k + 1) * (n_ - k_ - m_ + k + 1))  # noqa: E731  p(k + 1) / p(k)
        bounds = F.struct(mode.alias("mode"), low.alias("low"), high.alias("high"))

        def within(b: Column) -> Column:
            rise = F.when(b["high"] > b["mode"], F.sequence(b["mode"], b["high"] - 1)).otherwise(F.array().cast("array<bigint>"))
            fall = F.when(b["low"] < b["mode"], F.sequence(b["mode"] - 1, b["low"])).otherwise(F.array().cast("array<bigint>"))

            def walk(steps: Column, ratio, step: int, first: Column, stop: Column) -> Column:
                """Sum of the weights along the steps, and the last value whose weights before it stay within ``stop``."""
                start = F.struct(F.lit(1.0).alias("w"), first.alias("sum"), b["mode"].alias("at"))

                def move(s: Column, k: Column) -> Column:
                    w = s["w"] * ratio(k)
                    return F.struct(
                        w.alias("w"), (s["sum"] + w).alias("sum"), F.when(s["sum"] <= stop, k + step).otherwise(s["at"]).alias("at")
                    )

                return F.aggregate(steps, start, move)

            ascending = lambda stop: walk(rise, up, 1, F.lit(1.0), stop)  # noqa: E731  up to k + 1
            descending = lambda stop: walk(fall, lambda k: 1 / up(k), 0, F.lit(0.0), stop)  # noqa: E731  down to k
            sums = F.struct(ascending(F.lit(-1.0))["sum"].alias("up"), descending(F.lit(-1.0))["sum"].alias("down"))

            def choose(s: Column) -> Column:
                t = x["u"] * (s["up"] + s["down"])
                return F.when(t < s["up"], ascending(t)["at"]).otherwise(descending(t - s["up"])["at"])

            return _let(sums, choose)

        return F.when(n_ <= 0, F.lit(0).cast("bigint")).otherwise(_let(bounds, within))

    return _let(inputs, invert)


def split_tree(slots: DataFrame, shards: int, seed: int) -> DataFrame:
    """source and ``ends``: how many of a source's slots the shards up to each get, from (source, slots).

    ``shards`` is a power of two. Shards differ by one slot in total at most for each level of the tree.
    """
    assert shards & (shards - 1) == 0 < shards, "shards: a power of two"
    order = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "slots")))
    node = slots.agg(order.alias("all")).select(
        F.col("all.source").alias("sources"), F.col("all.slots").alias("counts"), F.lit(0).cast("bigint").alias("path")
    )
    for _ in range(shards.bit_length() - 1):
        total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
        start = F.struct(
            total.alias("left"), F.floor((total + F.col("path") % 2) / 2).alias("draw"), F.array().cast("array<bigint>").alias("out")
        )

        def deal(state: Column, i: Column) -> Column:
            count = F.get("counts", i)
            got = hypergeometric(count, state["left"], state["draw"], _uniform(F.lit(seed), F.col("path"), i, F.size("counts")))
            take = lambda g: F.struct(
                (state["left"] - count).alias("left"), (state["draw"] - g).alias("draw"), F.concat(state["out"], F.array(g)).alias("out")
            )
            return _let(got, take)

        steps = F.when(F.size("counts") > 0, F.sequence(F.lit(0), F.size("counts") - 1)).otherwise(F.array().cast("array<int>"))
        node = node.withColumn("half", F.aggregate(steps, start, deal, lambda s: s["out"]))
        rest = F.zip_with("counts", "half", lambda a, b: a - b)
        children = F.array(
            F.struct(F.col("half").alias("counts"), (F.col("path") * 2).alias("path")),
            F.struct(rest.alias("counts"), (F.col("path") * 2 + 1).alias("path")),
        )
        node = node.select("sources", F.explode(children).alias("child")).select("sources", "child.counts", "child.path")
    leaves = node.select("path", F.posexplode("counts").alias("number", "n"), F.col("sources"))
    leaves = leaves.select("path", "number", F.get("sources", F.col("number")).alias("source"), "n")
    ends = F.sum("n").over(Window.partitionBy("number").orderBy("path"))
    leaves = leaves.withColumn("end", ends).groupBy("number", "source").agg(F.array_sort(F.collect_list(F.struct("path", "end"))).alias("e"))
    return leaves.select("source", F.col("e.end").alias("ends"))


def shards_for(plan: DataFrame) -> int:
    """A power of two, by the slots that a plan (rounds, rest and mask of each source) has at most."""
    slots = plan.agg(F.sum((F.col("rounds") + (F.col("rest") > 0).cast("bigint")) * (F.col("mask") + 1))).first()[0] or 0
    return max(SHARDS, 1 << (-(-int(slots) // SLOTS) - 1).bit_length()) if slots else SHARDS


def mix(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, taken, copies, mark, number and draws.

    ``draws`` lists each slot dealt to a shard that takes the document: round, shard, words, a random place in the shard
    and whether it counts as a whole document (half of it or more). ``taken`` is the sum of their words and ``copies`` the
    number of those that count. Texts without words are drawn with 0 words. ``mark`` tells rows of one id apart by their
    text and source, ``number`` (from 0) those that are equal in that too. The number of shards follows from the slots where it is not given.
    """
    # Written out: sizes, blocks and documents all start from these few numbers, and the texts are read once.
    own = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), F.xxhash64("text", "source").alias("mark"))
    own = own.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("times"))
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)
    own = checkpointed(own.select("doc_id", "source", "size", "mark", F.explode(numbers).alias("number")))
    sizes = own.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(sizes).withColumn("quota", F.least(F.round("target").cast("bigint"), MOST * F.col("source_size")))
    plan = plan.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0))
    plan = plan.withColumn("rest", F.col("quota") - F.col("rounds") * F.col("source_size"))
    bits = F.greatest(F.ceil(F.log2(F.col("n").cast("double")) / 2), F.ceil(F.log2(F.col("n") / BLOCK)))
    plan = plan.withColumn("mask", F.pow(F.lit(2.0), bits).cast("bigint") - 1)
    plan = plan.select("source", "source_size", "target", "rounds", "rest", "mask")
    shards = shards or shards_for(plan)

    # A null source is a source: it is joined as a value of its own.
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    a, b = own.alias("a"), plan.alias("b")
    placed = a.join(b, same(own, plan)).select(
        "a.doc_id", "a.source", "a.size", "a.mark", "a.number", "b.source_size", "b.target", "b.rounds", "b.rest",
        F.xxhash64(F.lit(seed), "a.doc_id", "a.mark", "a.number").bitwiseAND(F.col("b.mask")).alias("block"),
    )

    blocks = placed.groupBy("source", "block", "rounds", "rest").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "block"), "block")
    blocks = blocks.withColumn("rank", F.row_number().over(order) - 1)
    blocks = blocks.withColumn("before", F.sum("words").over(order) - F.col("words"))
    blocks = blocks.withColumn("stop", F.greatest(F.col("rest") - F.col("before"), F.lit(0)))
    slots = blocks.groupBy("source").agg(
        F.sum(F.col("rounds") + (F.col("stop") > 0).cast("bigint")).alias("slots"), F.count("*").alias("in_round")
    )
    ends = split_tree(slots.select("source", "slots"), shards, seed)
    edges = F.zip_with(F.concat(F.array(F.lit(0).cast("bigint")), "ends"), "ends", lambda a, b: F.struct(a.alias("first"), b.alias("end")))
    dealt = ends.select("source", F.posexplode(edges).alias("shard", "e")).filter("e.first < e.end")
    dealt = dealt.select("source", "shard", F.explode(F.sequence(F.col("e.first"), F.col("e.end") - 1)).alias("slot"))
    wanted = blocks.alias("b").join(slots.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
    drawn = F.col("b.rounds") + (F.col("b.stop") > 0).cast("bigint")
    wanted = wanted.filter(drawn > 0).select("b.*", "s.in_round", F.explode(F.sequence(F.lit(0).cast("bigint"), drawn - 1)).alias("round"))
    wanted = wanted.withColumn("slot", F.col("round") * F.col("in_round") + F.col("rank"))
    got = wanted.alias("w").join(dealt.alias("d"), F.col("w.source").eqNullSafe(F.col("d.source")) & (F.col("w.slot") == F.col("d.slot")))
    got = got.groupBy("w.source", "w.block").agg(F.array_sort(F.collect_list(F.struct("w.round", "d.shard"))).alias("slots"))
    own_slots = F.coalesce(F.col("g.slots"), F.array().cast("array<struct<round:bigint,shard:int>>"))
    blocks = blocks.alias("b").join(
        got.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")) & (F.col("b.block") == F.col("g.block")), "left"
    )
    blocks = blocks.select(F.col("b.source").alias("source"), F.col("b.block").alias("block"), "b.stop", own_slots.alias("slots"))

    both = placed.alias("p").join(
        blocks.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.block") == F.col("b.block"))
    )
    within = Window.partitionBy("p.source", "p.block").orderBy(
        F.xxhash64(F.lit(seed + 2), "p.doc_id", "p.mark", "p.number"), "p.doc_id", "p.mark", "p.number"
    )
    both = both.withColumn("__left", F.col("b.stop") - (F.sum("p.size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("p.size")))
    last = F.greatest(F.lit(0), F.least(F.col("p.size"), F.col("__left")))
    words = lambda k: F.when(k < F.col("p.rounds"), F.col("p.size")).otherwise(last)
    whole = lambda k: (k < F.col("p.rounds")) | (F.col("__left") > 0) & (2 * F.col("__left") >= F.col("p.size"))
    draw = lambda s: F.struct(
        s["round"].alias("round"), s["shard"].alias("shard"), words(s["round"]).alias("words"),
        F.xxhash64(F.lit(seed + 3), "p.doc_id", "p.mark", "p.number", s["round"]).alias("place"), whole(s["round"]).alias("whole"),
    )
    both = both.withColumn("draws", F.filter(F.transform("b.slots", draw), lambda d: (d["words"] > 0) | d["whole"]))
    return both.select(
        "p.doc_id", "p.source", "p.size", "p.source_size", "p.target",
        F.aggregate("draws", F.lit(0).cast("bigint"), lambda a, d: a + d["words"]).alias("taken"),
        F.size(F.filter("draws", lambda d: d["whole"])).cast("bigint").alias("copies"),
        "p.mark", "p.number", "draws",
    )


def deal(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row for each draw, by shard and shuffled within it; each shard is of one task.

    Columns other than draws come along.
    """
    rest = [F.col(f"`{c}`") for c in mixed.columns if c != "draws"]
    drawn = mixed.select(*rest, F.explode("draws").alias("__d")).select(*rest, "__d.*")
    return drawn.repartition("shard").sortWithinPartitions("shard", "place", "doc_id", "round")


def mixed_documents(docs: DataFrame, shards: int | None = None, seed: int = 7) -> DataFrame:
    """``docs`` as dealt: one row for each drawn slot of a document, by shard and shuffled within it.

    A row at a source's stop counts where half of it is taken.
    """
    draws = F.filter("draws", lambda d: d["whole"])
    times = mix(docs, shards, seed).filter("copies > 0").select("doc_id", "mark", "number", draws.alias("draws"))
    kind = Window.partitionBy("doc_id", "__mark").orderBy(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns)))
    marked = docs.withColumn("__mark", F.xxhash64("text", "source")).withColumn("__number", F.row_number().over(kind) - 1)
    d, t = marked.alias("d"), times.alias("t")
    same = (
        F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("d.__mark") == F.col("t.mark"))
        & (F.col("d.__number") == F.col("t.number"))
    )
    row = F.struct(*(F.col(f"d.`{c}`").alias(c) for c in docs.columns)).alias("__row")
    dealt = deal(d.join(t, same).select("d.doc_id", row, "t.draws"))
    return dealt.select(*(F.col(f"__row.`{c}`").alias(c) for c in docs.columns))
