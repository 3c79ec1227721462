"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson without forming a matrix.

The covariance V is met only as a product with a few vectors: each task multiplies its centred rows, and the partial
sums are added up by a shuffle. The outer loop is a Rayleigh-Ritz step over a small subspace; the leading Ritz pair is
locked as soon as its residual is down to rounding. For the others the correction equations, projected against locked and
current Ritz vectors, are solved by some steps of MINRES, all pairs in step, so that one product serves them all.

Only vectors of as many entries as a row has reach the driver, some ``MOST_BASIS`` of them; rows never do. The products
read blocks of whole numbers from the shared folder, as many bytes a number as a block needs.

Entries c become x = floor(1024 c) + 100000 (held at +-2**53, beyond which a double skips whole numbers). A vector that is null
or holds null or non-finite entries is dropped. Shorter vectors count as filled up with zeros. Rows without an id and
repeated rows are rows like any other. There are no more components than V has eigenvalues above rounding: equal vectors,
a single row, empty vectors and an empty table give no rows. A deviation that does not fit a long is NULL. The order of
equal eigenvalues is arbitrary but the same for all rows; the sign of a component makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywing.llm.shared import checkpointed

SCALE, SHIFT, MOST = 1024.0, 100000, float(1 << 53)
#: Columns of the subspace before it is cut back to the leading Ritz vectors.
MOST_BASIS = 48
INNER = 12
#: Bytes of doubles in a block.
BLOCK = 8 << 20

Product = Callable[[np.ndarray], np.ndarray]


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite entry."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(F.forall(F.col(vector), entry), F.lit(False))


def whole_numbers(vectors: pa.ListArray, size: int) -> np.ndarray:
    """Rows of x, as longs, filled up to ``size`` entries."""
    length = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(length), size))
    out[np.arange(size) < length[:, None]] = flat
    return np.clip(np.floor(out * SCALE) + SHIFT, -MOST, MOST).astype(np.int64)


def _blocks(frame: DataFrame, vector: str, size: int) -> DataFrame:
    """``rows`` and ``content``: x of some rows, in the narrowest kind of whole number that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // (8 * size))
        for b in batches:
            for i in range(0, b.num_rows, step):
                x = whole_numbers(b.column(0).slice(i, step), size)
                kind = np.int32 if np.abs(x).max() < 1 << 31 else np.int64
                content = pa.array([x.astype(kind).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), content], ["rows", "content"])

    return frame.select(vector).mapInArrow(run, "rows bigint, content binary")


def _read(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    for rows, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        raw = content.as_buffer()
        yield np.frombuffer(raw, dtype=f"<i{raw.size // (rows * size)}").reshape(rows, size)


def _sums(blocks: DataFrame, size: int) -> list[int]:
    """The exact sum of each dimension, from sums of the upper and lower 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = [0] * size, [0] * size
        for b in batches:
            for x in _read(b, size):
                wide = x.astype(np.int64)
                high = [a + c for a, c in zip(high, (wide >> 32).sum(axis=0).tolist(), strict=True)]
                low = [a + c for a, c in zip(low, (wide & 0xFFFFFFFF).sum(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_pydict({"at": list(range(size)), "high": high, "low": low})

    wide = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    rows = blocks.mapInArrow(run, "at bigint, high bigint, low bigint").groupBy("at").agg(*wide).collect()
    return [(int(h) << 32) + int(low) for _, h, low in sorted(tuple(r) for r in rows)]


def _added(blocks: DataFrame, size: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over all blocks: added up in each task, then cell by cell by a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, lost = np.zeros(shape), np.zeros(shape)
        for b in batches:
            for x in _read(b, size):
                term = part(x) - lost
                after = total + term
                lost = (after - total) - term
                total = after
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])

    cells = blocks.mapInArrow(run, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(shape)
    for cell, value in cells.collect():
        out.flat[cell] = value
    return out


def minres(product: Product, rhs: np.ndarray, steps: int, down_to: float) -> np.ndarray:
    """Each column x of ``product(x) = rhs`` after ``steps`` steps, or as soon as all residuals fell to ``down_to`` of theirs.

    ``product`` takes all columns at once; each column has its own recurrence.
    """
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    safe = lambda a: np.where(a > 0, a, 1.0)
    before, now = np.zeros_like(rhs), rhs / safe(beta)
    w0, w1 = np.zeros_like(rhs), np.zeros_like(rhs)
    cos0 = cos1 = np.ones(rhs.shape[1])
    sin0 = sin1 = np.zeros(rhs.shape[1])
    left, goal = beta.copy(), beta * down_to
    beta = np.zeros_like(beta)
    for _ in range(steps):
        after = product(now)
        alpha = np.sum(now * after, axis=0)
        after = after - alpha * now - beta * before
        norm = np.linalg.norm(after, axis=0)
        delta = cos1 * alpha - cos0 * sin1 * beta
        rho1 = safe(np.hypot(delta, norm))
        rho2 = sin1 * alpha + cos0 * cos1 * beta
        rho3 = sin0 * beta
        cos0, sin0, cos1, sin1 = cos1, sin1, delta / rho1, norm / rho1
        w0, w1 = w1, (now - rho3 * w0 - rho2 * w1) / rho1
        x = x + cos1 * left * w1
        left = -sin1 * left
        before, now, beta = now, after / safe(norm), norm
        if np.all(np.abs(left) <= goal) or np.all(norm == 0):
            break
    return x


def _orthogonal(v: np.ndarray, *to: np.ndarray) -> np.ndarray:
    """Columns of ``v`` made orthonormal and orthogonal to ``to``; those that depend on the rest are left out."""
    for _ in range(3):
        for q in to:
            v = v - q @ (q.T @ v)
        norms = np.linalg.norm(v, axis=0)
        v = v[:, norms > 1e-300] / norms[norms > 1e-300]
        u, s, _ = np.linalg.svd(v, full_matrices=False)
        v = u[:, s > 1e-8 * s[0]] if len(s) else u[:, :0]
    return v


@dataclass
class Components:
    vectors: np.ndarray  # columns
    values: np.ndarray
    products: int


def jacobi_davidson(product: Product, size: int, k: int, rounds: int = 60, seed: int = 12) -> Components:
    """The ``k`` leading eigenpairs of a symmetric positive semidefinite matrix given by its products.

    A pair is locked when its residual is at most 64 rounding errors of the leading eigenvalue, or when it is close to that
    and does not fall any more (sums over very many rows round more).
    """
    eps, count = np.finfo(float).eps, 0

    def times(v: np.ndarray) -> np.ndarray:
        nonlocal count
        count += 1
        return product(v)

    basis = _orthogonal(np.random.default_rng(seed).normal(size=(size, min(size, k + 4))))
    image = times(basis)
    locked, values = np.zeros((size, 0)), []
    last = np.inf
    for _ in range(rounds):
        theta, s = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        ritz, images = basis @ s, image @ s
        residuals = images - ritz * theta
        residuals = residuals - locked @ (locked.T @ residuals)
        norms = np.linalg.norm(residuals, axis=0)
        scale = max([*values, theta[0] if len(theta) else 0.0], default=0.0)
        done = 0
        while done < len(theta) and len(values) + done < k:
            fine = norms[done] <= 64 * eps * scale or norms[done] <= 1e-12 * scale and norms[done] > last / 2
            if not fine:
                break
            done, last = done + 1, np.inf
        locked, values = np.hstack([locked, ritz[:, :done]]), [*values, *theta[:done].tolist()]
        basis, image, residuals, theta, norms = ritz[:, done:], images[:, done:], residuals[:, done:], theta[done:], norms[done:]
        if len(values) == k or not len(theta):
            break
        last = norms[0]
        if locked.shape[1] + basis.shape[1] == size:  # the whole space: Ritz pairs are exact up to rounding
            rest = min(k - len(values), len(theta))
            locked, values = np.hstack([locked, basis[:, :rest]]), [*values, *theta[:rest].tolist()]
            break
        aims = min(k - len(values), len(theta))
        if basis.shape[1] + aims > MOST_BASIS:
            basis, image = basis[:, : MOST_BASIS // 2], image[:, : MOST_BASIS // 2]
        around = np.hstack([locked, basis[:, :aims]])
        off = lambda v, q=around: v - q @ (q.T @ v)
        shift = theta[:aims]
        open_ = norms[:aims] > 64 * eps * scale

        def projected(v: np.ndarray, shift=shift[open_], off=off) -> np.ndarray:
            v = off(v)
            return off(times(v) - v * shift)

        moves = minres(projected, -off(residuals[:, :aims][:, open_]), INNER, 0.02) if open_.any() else residuals[:, :0]
        new = _orthogonal(np.hstack([moves, residuals[:, :aims][:, open_]]) if not moves.any() else moves, locked, basis)
        if not new.shape[1]:
            new = _orthogonal(np.random.default_rng(seed + len(values) + count).normal(size=(size, 1)), locked, basis)
        if not new.shape[1]:
            continue
        basis, image = np.hstack([basis, new]), np.hstack([image, times(new)])
    order = np.argsort(-np.array(values), kind="stable")
    return Components(locked[:, order], np.array(values)[order], count)


def whiten(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8) -> DataFrame:
    """``key``, component, n, deviation, whitened, explained and identity_error, a row for each vector and component."""
    kind = frame.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = frame.select(key, vector).filter(usable(vector))
    size = rows.agg(F.max(F.size(vector))).first()[0] or 0
    if not size:
        return rows.sparkSession.createDataFrame([], schema)
    blocks = checkpointed(_blocks(rows, vector, size))
    n = blocks.agg(F.sum("rows")).first()[0]
    sums = _sums(blocks, size)
    # x - S / n without rounding S / n first: both parts of the mean are subtracted in turn.
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole) - rest

    def product(v: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ v)

        return _added(blocks, size, v.shape, part) / n

    trace = _added(blocks, size, (1, 1), lambda x: np.square(centred(x)).sum(keepdims=True))[0, 0] / n
    if not trace > 0:
        return rows.sparkSession.createDataFrame([], schema)
    found = jacobi_davidson(product, size, min(k, size))
    real = found.values > size * np.finfo(float).eps * max(found.values[0], 0)
    values, vectors = found.values[real], found.vectors[:, real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    scaled = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = np.hstack([centred(x) @ scaled, np.ones((len(x), 1))])
        return w.T @ w

    m = _added(blocks, size, (len(values) + 1,) * 2, moments) / n
    error = float(np.abs(m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1]) - np.eye(len(values))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole_numbers(b.column(1), size)
            w = centred(x) @ scaled
            deviation = _deviations(x, n, sums)
            each = len(values)
            ids = pa.array(np.repeat(np.arange(len(x)), each))
            columns = [b.column(0).take(ids), pa.array(np.tile(np.arange(1, each + 1), len(x)), pa.int32()), pa.array(np.full(len(ids), n), pa.int64())]
            columns += [pa.array(deviation, pa.int64()).take(ids), pa.array(w.ravel()), pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(ids), error))]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2: in longs where none can overflow, in whole numbers of any size elsewhere."""
    most = max([abs(int(x.max())), abs(int(x.min()))], default=0) * n if x.size else 0
    widest = most + max(map(abs, sums))
    if widest * widest * x.shape[1] < 1 << 62:
        d = x * n - np.array(sums, dtype=np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]
