"""Approximate nearest neighbours by learned partitions, for the largest inner product.

1. On a bounded sample of vectors (those with the least hash of their id), the graph of nearest neighbours is divided
   into parts of equal size that cut few links, by repeated bisection.
2. A small classifier learns which parts the neighbours of a vector lie in. It gives every vector of the table its most
   probable part, and sends a query to several.
3. How many is measured: the least number of parts that holds ``recall`` of the true neighbours of vectors of the sample
   that the classifier did not see. Data without structure thus get more parts to search, not worse results.
4. Candidates of the chosen parts are ranked by their exact inner products in double precision.

A part is cut into slices of bounded size by a hash of the id, and queries into blocks, so that one frequent vector (or
one large part) is spread over tasks. A block of queries meets a slice in one group; only the best of each query leave
it. Model and counts have a bounded size; no vector beyond the sample reaches the driver.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id, nor vectors
of another length than the most frequent one (the shortest of these). A query's own rows (its id) are no candidates; a
query id that comes in several rows with different vectors is asked with the one that sorts first. Ties go to the
smaller id. Repeated rows of one id are one candidate each; a query may list an id twice then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4096
PARTS = 16
LINKS = 10
#: Rows of a slice and of a block of queries.
SLICE = 4096


@dataclass
class Partitions:
    """A classifier with one hidden layer, and how many of its parts a query asks."""

    weights: list[np.ndarray]
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.maximum(x @ a + b, 0) @ c + d


def neighbour_graph(x: np.ndarray, links: int) -> np.ndarray:
    """The ``links`` best others of each row."""
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    links = min(links, len(x) - 1)
    return np.argpartition(-s, links - 1, axis=1)[:, :links]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 20) -> np.ndarray:
    """A part for each row: repeated bisection of the graph, with swaps of pairs that cut more links than they mend."""
    part = np.zeros(len(x), dtype=np.int64)
    source = np.repeat(np.arange(len(x)), graph.shape[1])
    target = graph.ravel()
    for _ in range(parts.bit_length() - 1):
        side = np.zeros(len(x), dtype=np.int64)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            y = x[own] - x[own].mean(axis=0)
            v = rng.normal(size=x.shape[1])
            for _ in range(12):  # the direction of most variance
                v = y.T @ (y @ v)
                v /= np.linalg.norm(v) + 1e-300
            side[own[np.argsort(y @ v, kind="stable")[len(own) // 2 :]]] = 1
        for _ in range(rounds):
            same = part[source] == part[target]
            cut = np.where(same, np.where(side[source] != side[target], 1, -1), 0)
            gain = np.bincount(source, cut, len(x)) + np.bincount(target, cut, len(x))
            moved = 0
            for p in np.unique(part):
                own = np.flatnonzero(part == p)
                left, right = (own[side[own] == k] for k in (0, 1))
                left, right = (g[np.argsort(-gain[g], kind="stable")] for g in (left, right))
                n = min(len(left), len(right)) // 4
                both = gain[left[:n]] + gain[right[:n]] > 0
                side[left[:n][both]], side[right[:n][both]] = 1, 0
                moved += both.sum()
            if not moved:
                break
        part = part * 2 + side
    return part


def _classifier(x: np.ndarray, aim: np.ndarray, rng: np.random.Generator, hidden: int = 64, epochs: int = 30) -> list[np.ndarray]:
    """Adam on the cross-entropy to the shares ``aim``."""
    shapes = [(x.shape[1], hidden), (hidden,), (hidden, aim.shape[1]), (aim.shape[1],)]
    scale = 1 / (np.sqrt(np.mean(np.sum(x * x, axis=1))) + 1e-300)
    weights = [rng.normal(0, 1.0, shapes[0]) * scale, np.zeros(hidden), rng.normal(0, 0.1, shapes[2]), np.zeros(aim.shape[1])]
    moments = [(np.zeros(s), np.zeros(s)) for s in shapes]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 128):
            at = order[i : i + 128]
            a, b, c, d = weights
            h = np.maximum(x[at] @ a + b, 0)
            z = h @ c + d
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p = (p / p.sum(axis=1, keepdims=True) - aim[at]) / len(at)
            g = (p @ c.T) * (h > 0)
            step += 1
            for w, grad, (m, v), rate in zip(weights, [x[at].T @ g, g.sum(0), h.T @ p, p.sum(0)], moments, [0.005 * scale, 0.005, 0.005, 0.005], strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    return weights


def learn(x: np.ndarray, k: int, recall: float, seed: int = 3) -> Partitions:
    """From the sample's vectors. A sample of fewer than 32 vectors a part gets fewer parts."""
    rng = np.random.default_rng(seed)
    parts = PARTS
    while parts > 1 and len(x) < 64 * parts:
        parts //= 2
    if parts == 1:
        return Partitions([np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)], 1)
    seen = rng.permutation(len(x))
    seen, unseen = np.sort(seen[: len(x) * 3 // 4]), np.sort(seen[len(x) * 3 // 4 :])
    graph = neighbour_graph(x[seen], LINKS)
    part = balanced_parts(x[seen], graph, parts, rng)
    own = np.eye(parts)[part]
    weights = _classifier(x[seen], (own[graph].sum(axis=1) + own) / (graph.shape[1] + 1), rng)
    model = Partitions(weights, parts)
    # The true neighbours of unseen vectors, by the rank of their part among those the query would ask.
    s = x[unseen] @ x.T
    s[np.arange(len(unseen)), unseen] = -np.inf
    true = np.argsort(-s, axis=1)[:, : min(k, len(x) - 1)]
    assigned = model.logits(x).argmax(axis=1)
    rank = np.argsort(np.argsort(-model.logits(x[unseen]), axis=1), axis=1)
    found = np.take_along_axis(rank, assigned[true], axis=1)
    held = [(found < p).mean() for p in range(1, parts + 1)]
    model.probes = int(np.searchsorted(held, min(recall, held[-1]))) + 1
    return model


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    rows = vectors.filter("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    rows = rows.filter(~F.exists("vector", odd) & F.exists("vector", lambda v: v != 0))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("vector") == (length[0]["n"] if length else 0))


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def _routed(rows: DataFrame, model: Partitions, probes: int) -> DataFrame:
    """``rows`` with ``parts``: the most probable ones, best first."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                best = np.argsort(-model.logits(x), axis=1, kind="stable")[:, :probes].astype(np.int32)
                at = np.arange(b.num_rows + 1, dtype=np.int32) * best.shape[1]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(at, best.ravel())], ["vec_id", "vector", "parts"])

    return rows.mapInArrow(route, "vec_id bigint, vector array<double>, parts array<int>")


def best_of(queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, candidate_ids: np.ndarray, k: int) -> list[tuple]:
    """(query, candidate, score) of the k best candidates of each query other than itself; ties to the smaller id.

    A matrix product selects, with a margin for its rounding; what it selects is scored row by row, so that equal
    vectors get equal scores wherever they stand.
    """
    order = np.argsort(candidate_ids, kind="stable")
    candidates, candidate_ids = candidates[order], candidate_ids[order]
    out = []
    norms = np.sqrt((candidates**2).sum(axis=1)).max(initial=0)
    for i in range(0, len(queries), 256):
        rough = queries[i : i + 256] @ candidates.T
        for q, own, s in zip(queries[i : i + 256], ids[i : i + 256], rough, strict=True):
            s[candidate_ids == own] = -np.inf
            least = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
            margin = 1e-12 * (np.sqrt(q @ q) * norms)
            near = np.flatnonzero((s >= least - margin) & (s > -np.inf))
            score = (candidates[near] * q).sum(axis=1)
            for j in np.argsort(-score, kind="stable")[:k]:
                out.append((int(own), int(candidate_ids[near[j]]), float(score[j])))
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.98, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for each query; ``is_query`` is over ``vec_id``."""
    valid = _valid(vectors)
    rows = valid.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).select("vector").collect()
    if not rows:
        return valid.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    model = learn(_matrix(r["vector"] for r in rows), k, recall)

    placed = _routed(valid, model, 1).withColumn("part", F.get("parts", 0)).drop("parts")
    queries = valid.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one a part
    blocks = -(-max(1, queries.count()) // SLICE)
    slices = F.create_map(*(F.lit(x) for p, n in counts.items() for x in (p, -(-n // SLICE))))

    slice_ = F.pmod(F.xxhash64("vec_id"), F.get(F.array(slices[F.col("part")]), 0)).cast("int")
    candidates = placed.withColumn("slice", slice_).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = _routed(queries, model, model.probes).withColumn("block", F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("part", F.explode("parts")).drop("parts")
    asked = asked.withColumn("slice", F.explode(F.sequence(F.lit(0), slices[F.col("part")] - 1)))

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = best_of(_matrix(left["vector"]), left["vec_id"].to_numpy(), _matrix(right["vector"]), right["vec_id"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["part", "slice", "block"]
    each = asked.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(rank, "query_id bigint, vec_id bigint, score double")
    # The best of the slices, on the way to the query and there: nothing unbounded meets, as a slice sends k rows at most.
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))), 1, k)
    ranked = each.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("rank", "b"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"))
