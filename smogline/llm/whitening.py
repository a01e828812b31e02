"""Embedding whitening by Chebyshev-filtered subspace iteration.

A component c becomes the integer x = floor(scale * c) + SHIFT. The leading eigenvectors of the covariance V of x
are found without forming V: the only work on the vectors are passes that add up X'XQ of centred rows for a thin
block Q (each task one array, added up in Spark); everything on the driver has the size of Q.

1. One pass counts the rows and sums every dimension exactly; centring uses these.
2. Two passes on a random block and its image give Ritz values: the lower end of the unwanted spectrum and the
   first block.
3. A cycle applies a Chebyshev polynomial of V to the block by its three-term recurrence, one pass a degree. It is
   small on [low, cut], where ``cut`` is the block's smallest Ritz value, and grows fast above. Then QR, one more pass,
   and Rayleigh-Ritz. The degree is such that a cycle gains about ``GAIN``. Certified leading pairs are set aside, and
   the rest of the block is kept orthogonal to them.
4. It ends when every wanted pair is certified: the residual |Vq - eq| is at most ``TOLERANCE`` times e, or 10 times
   that of the largest eigenvalue once a cycle can't halve it (an eigenvector is then off by at most the residual over the gap to its neighbours; within equal
   eigenvalues any orthonormal basis is right). If a cycle doesn't bring residuals down, the lower end falls back
   to 0, which is safe because V has no negative eigenvalue.

The identity error is measured by a pass over the whitened rows. Blocks are written once as narrow integers, so a
pass costs one small read; its number grows with the closeness of eigenvalues, not with the rows.

Defined cases: vectors that are null, hold null or non-finite components (or integers of 2^55 and more)
take no part, nor do those whose dimension isn't the most frequent one (the smaller on a tie); rows with equal or null
ids are rows of their own; components without variance (below 1e-12 of the largest) are not returned, so an
empty table, a single row or rows that are all equal give no rows; with fewer dimensions than components there are
as many as dimensions; ``deviation`` is exact, null beyond the range of a decimal(38) in ``whiten`` and of a long
in the query; only the id and the vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.vectors import id_lists, integer_blocks, matrices, summed, vector_size

SCALE = 1024.0
SHIFT = 100_000
COMPONENTS = 8
#: Columns of the block for each wanted component.
WIDEN = 3
TOLERANCE = 1e-13
#: Factor by which one cycle lifts the last wanted component over the cut, the most by which it may lift any (so that
#: the block keeps its rank in doubles), and the longest recurrence.
GAIN = 1e8
SPREAD = 1e11
MAX_DEGREE = 40
MAX_CYCLES = 60

WHITE = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
         "identity_error double")


@dataclass
class Whitening:
    """Components (columns) with eigenvalues, from ``n`` rows with exact per-dimension sums (without the shift)."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # of Python integers: correctly rounded

    @property
    def axes(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def column_sums(blocks: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(rows, exact sum of every dimension)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (dim + 1)
        for batch in batches:
            for x in matrices(batch, dim):
                wide = x.astype(object) if x.dtype.itemsize == 8 else x.astype(np.int64)  # sums of 8 bytes may overflow
                totals = [a + int(b) for a, b in zip(totals, [len(x), *wide.sum(0)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([[Decimal(t) for t in totals]], pa.list_(pa.decimal128(38, 0)))], ["part"])

    n, *sums = [int(v) for v in summed(blocks.select("width", "data").mapInArrow(run, "part array<decimal(38,0)>"))] or [0]
    return n, sums


def covariance_times(blocks: DataFrame, mean: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """(V q, trace of V) by one pass over the centred rows."""
    dim, m = q.shape
    shared = blocks.sparkSession.sparkContext.broadcast((mean, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, thin = shared.value
        total, square = np.zeros((dim, m)), 0.0
        for batch in batches:
            for x in matrices(batch, dim):
                y = x - centre
                total += y.T @ (y @ thin)
                square += float((y * y).sum())
        yield pa.RecordBatch.from_arrays([pa.array([[*total.ravel().tolist(), square]], pa.list_(pa.float64()))], ["part"])

    found = np.array(summed(blocks.select("width", "data").mapInArrow(run, "part array<double>")))
    shared.destroy()
    return found[:-1].reshape(dim, m) / n, float(found[-1]) / n


def rayleigh_ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(Ritz values, falling; their vectors; V times these) of an orthonormal block and its image."""
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, q @ turn, vq @ turn


def chebyshev_filter(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, degree: int, low: float,
                     cut: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V on [low, cut], applied to ``q`` (``vq`` is V q): degree - 1 products."""
    centre, half = (cut + low) / 2, (cut - low) / 2
    sigma = half / (top - centre)
    twice = 2 / sigma
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (twice - sigma)
        before, now = now, 2 * (following / half) * (times(now) - centre * now) - sigma * following * before
        sigma = following
    return now


def leading_pairs(times: Callable[[np.ndarray], np.ndarray], dim: int, k: int, tolerance: float = TOLERANCE,
                  seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residuals) of the ``k`` largest eigenvalues of a positive semidefinite operator."""
    k, m = min(k, dim), min(dim, WIDEN * k)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, m)))
    vq = times(q)
    low = 0.0
    if m < dim:  # the span of the block and its image: Ritz values near both ends, and a better block
        extra, _ = np.linalg.qr(vq - q @ (q.T @ vq))
        extra = extra[:, :dim - m]
        extra, _ = np.linalg.qr(extra - q @ (q.T @ extra))
        values, vectors, images = rayleigh_ritz(np.hstack((q, extra)), np.hstack((vq, times(extra))))
        low = max(0.0, values[-1] - float(np.linalg.norm(images[:, -1] - values[-1] * vectors[:, -1])))
        q, vq = vectors[:, :m], images[:, :m]
    kept_values, kept, kept_residuals = np.empty(0), np.empty((dim, 0)), np.empty(0)
    largest, best = 0.0, math.inf
    for _ in range(MAX_CYCLES):
        values, q, vq = rayleigh_ritz(q, vq)
        largest = max(largest, float(values[0]))
        if largest <= 0:
            return values[:k], q[:, :k], np.zeros(k)
        left = k - len(kept_values)
        residuals = np.linalg.norm(vq - q * values, axis=0)[:left]
        own = np.where(values[:left] > 1e-12 * largest, values[:left], largest)
        worst = float((residuals / own).max())
        fine = residuals <= tolerance * own
        if m == dim or (best / 2 < worst and residuals.max() <= 10 * tolerance * largest):
            fine[:] = True  # exact, or at the level of rounding
        done = left if fine.all() else int(fine.argmin())
        kept_values, kept_residuals = np.r_[kept_values, values[:done]], np.r_[kept_residuals, residuals[:done]]
        kept = np.hstack((kept, q[:, :done]))
        if done == left:
            order = np.argsort(-kept_values, kind="stable")
            return kept_values[order], kept[:, order], kept_residuals[order]
        if worst > best / 2:
            low = 0.0
        best = worst if done == 0 else math.inf
        wanted, cut, top = float(values[left - 1]), float(values[-1]), float(values[done])
        if cut - low <= 1e-9 * top:
            low, cut = 0.0, max(cut, 1e-6 * top)
        degree = min(MAX_DEGREE, _degree(2 * GAIN, wanted, low, cut, math.ceil), _degree(SPREAD, top, low, cut, math.floor))
        rest = lambda y, kept=kept: y - kept @ (kept.T @ y)
        q = chebyshev_filter(lambda y: rest(times(y)), q[:, done:], rest(vq[:, done:]), max(1, degree), low, cut, top)
        q, _ = np.linalg.qr(rest(q))
        q, _ = np.linalg.qr(rest(q))
        vq = rest(times(q))
    raise RuntimeError(f"no certified eigenvectors after {MAX_CYCLES} cycles: relative residual {best:.1e}")


def _degree(gain: float, value: float, low: float, cut: float, whole: Callable[[float], int]) -> int:
    """The degree at which the polynomial of [low, cut] reaches ``gain`` at ``value``."""
    x = 1 + 2 * (value - cut) / (cut - low)
    return whole(math.log(gain) / math.acosh(x)) if x > 1 + 1e-9 else MAX_DEGREE


def fit(blocks: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the rows of ``blocks``; None if nothing varies."""
    n, sums = column_sums(blocks, dim) if dim else (0, [])
    if not n:
        return None
    model = Whitening(n, sums, np.empty((dim, 0)), np.empty(0), 0.0, np.empty(0), 0)
    mean = model.mean

    def times(q: np.ndarray) -> np.ndarray:
        product, model.trace = covariance_times(blocks, mean, q, n)
        model.passes += 1
        return product

    values, vectors, residuals = leading_pairs(times, dim, components)
    real = values > 1e-12 * max(values[0], 0.0)
    if not real.any() or values[0] <= 0:
        return None
    vectors, model.values, model.residuals = vectors[:, real], values[real], residuals[real]
    heads = np.abs(vectors).argmax(0)
    model.vectors = vectors * np.sign(vectors[heads, np.arange(vectors.shape[1])])
    model.identity_error = _identity_error(blocks, model)
    return model


def _identity_error(blocks: DataFrame, model: Whitening) -> float:
    dim, k = model.vectors.shape
    mean, axes, n = model.mean, model.axes, model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for x in matrices(batch, dim):
                w = (x - mean) @ axes
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["part"])

    found = np.array(summed(blocks.select("width", "data").mapInArrow(run, "part array<double>"))).reshape(k + 1, k) / n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sum over dimensions of (n * x - sum)^2 for every row (null beyond 38 digits)."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if len(sums) * (2 * n * most) ** 2 < 1 << 62:
        d = n * x.astype(np.int64) - np.array(sums, np.int64)
        return pa.array((d * d).sum(1)).cast(pa.decimal128(38, 0))
    d = n * x.astype(object) - np.array(sums, object)
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in (d * d).sum(1)], pa.decimal128(38, 0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """One row per usable vector and component: the whitened value, with the exact deviation of the vector."""
    dim = vector_size(embeddings)
    blocks = integer_blocks(embeddings, max(dim, 1), scale, name="whitening") if dim else None
    model = fit(blocks, dim, components) if dim else None
    if model is None:
        return embeddings.sparkSession.createDataFrame([], WHITE)
    mean, axes, explained = model.mean, model.axes, model.values / model.trace
    k, n, sums, error = len(explained), model.n, model.sums, model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(id_lists(batch), matrices(batch, dim), strict=True):
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(len(each), n), pa.int64()), deviations(x, n, sums).take(pa.array(each)),
                     pa.array(((x - mean) @ axes).ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(run, WHITE)


def whitening_digest(rows: DataFrame) -> DataFrame:
    """The rows with the deviation as a long (null beyond its range)."""
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
