"""Centroid clustering of integer vectors by progressive search on Walsh-Hadamard coefficients.

Components become integers floor(scale * x). The transform H has only +1 and -1 and H'H = dim * I, so that it is exact on
integers and keeps squared distances times dim. Its rows are put in the order of their sign changes: the first
coefficients are coarse sums over long stretches, the last ones fine differences.

For a block of vectors the squared coefficient differences to all centroids are added up coarse to fine, group by group. A
partial sum is a lower bound; the leader after each group is finished at once and gives each vector an upper
bound. Centroids whose partial sum is strictly above it are given up; the others go on to the next group (by a matrix
product for the vectors with many left, pair by pair for those with few) and in the end have all coefficients, so
distances and ties are exact (the smaller number wins).

The blocks hold the transformed integers and are written once. A round is one pass: every task returns the exact sum and
count of each cluster, and Spark adds them up. Sums of coefficients are transformed back on the driver (exactly, by
the same transform and a division by dim), which only ever holds the centroids.

Defined cases: vectors that are null, of another dimension, or with null or non-finite components (or integers
of 2^55 and more) take no part; rows with equal ids are vectors of their own; a null id can't be a first
centroid; equal hashes are ordered by the vector; fewer vectors than centroids give fewer; an empty table
gives an empty result; values that a long can't hold (distance, inertia) are null; only the id and the vector
are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import written
from smogline.llm.vectors import id_lists, integer_blocks, matrices, summed

DIM = 64
SCALE = 256.0
CENTROIDS = 40
ROUNDS = 5
SALT = "2:"
#: Coefficients of the first, dense group; each later group doubles the coefficients seen.
COARSE = 8
#: A row with at most one part in so many of the centroids left is finished pair by pair.
FEW = 4

ASSIGNED = "vec_id long, cluster int, distance decimal(38,0)"


def sequency_order(dim: int) -> np.ndarray:
    """Row numbers of the butterfly's transform by their number of sign changes."""
    h = np.array([[1]])
    while len(h) < dim:
        h = np.block([[h, h], [h, -h]])
    return np.argsort((h[:, 1:] != h[:, :-1]).sum(1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The exact transform of every row, coarse coefficients first (``dim`` is a power of two)."""
    n, dim = x.shape
    if dim & (dim - 1):
        raise ValueError(f"{dim} components: not a power of two")
    if x.dtype != object:
        most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        x = x.astype(np.int64) if most * dim < 1 << 62 else x.astype(object)
    h = 1
    while h < dim:
        pairs = x.reshape(n, dim // (2 * h), 2, h)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(n, dim)
        h *= 2
    return x[:, sequency_order(dim)]


def untransform(y: np.ndarray) -> np.ndarray:
    """``dim`` times the rows whose transform is ``y``."""
    dim = y.shape[1]
    back = np.empty_like(y)
    back[:, sequency_order(dim)] = y
    n, h = len(y), 1
    while h < dim:
        pairs = back.reshape(n, dim // (2 * h), 2, h)
        back = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(n, dim)
        h *= 2
    return back


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays in the fastest type in which sums of squared differences are exact."""
    most = max((max(abs(int(a.min())), abs(int(a.max()))) for a in arrays if a.size), default=0)
    return [a.astype(np.float64 if most < 1 << 22 else np.int64 if most < 1 << 27 else object) for a in arrays]


def _group_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared differences of every row of ``x`` to every row of ``c``."""
    if x.dtype == np.float64:  # whole numbers below 2^53: a matrix product is exact
        return (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T)
    d = x[:, None, :] - c[None]
    return (d * d).sum(2)


def progressive_nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared coefficient distance, coefficient differences looked at) of transformed rows."""
    x, c = _exact(x, centroids)
    (n, dim), k = x.shape, len(c)
    nearest, far = np.zeros(n, np.int64), np.zeros(n, object if x.dtype == object else np.int64)
    own, partial, upper, at, looked = np.arange(n), np.zeros((n, k), x.dtype), None, 0, 0
    while True:  # rows with many centroids in the race: a group of coefficients for all of them
        upto, each = min(dim, max(COARSE, 2 * at)), np.arange(len(own))
        partial += _group_distances(x[own, at:upto], c[:, at:upto])
        looked, at = looked + len(own) * k * (upto - at), upto
        lead = partial.argmin(1)  # the smallest number among equals
        if at == dim:
            nearest[own], far[own] = lead, partial[each, lead]
            return nearest, far, looked
        rest = x[own, at:] - c[lead, at:]
        finished = partial[each, lead] + (rest * rest).sum(1)
        looked += rest.size
        upper = finished if upper is None else np.minimum(upper, finished)
        alive = partial <= upper[:, None]  # strictly worse ones go
        few = FEW * alive.sum(1) <= k
        if few.any():
            done = own[few]
            nearest[done], far[done], more = _finish_pairs(x[done], c, alive[few], partial[few], upper[few], at)
            looked += more
            own, partial, upper = own[~few], partial[~few], upper[~few]
        if not len(own):
            return nearest, far, looked


def _finish_pairs(x: np.ndarray, c: np.ndarray, alive: np.ndarray, partial: np.ndarray, upper: np.ndarray,
                  at: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The race of the ``alive`` centroids of each row, from coefficient ``at`` on."""
    dim, looked = x.shape[1], 0
    rows, cols = np.nonzero(alive)
    part = partial[rows, cols]
    while True:
        upto = min(dim, 2 * at)
        d = x[rows, at:upto] - c[cols, at:upto]
        part = part + (d * d).sum(1)
        looked, at = looked + d.size, upto
        starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
        if at == dim:
            least = np.minimum.reduceat(part, starts)
            lead = np.flatnonzero(part == np.repeat(least, np.diff(np.append(starts, len(part)))))
            return cols[lead[np.concatenate(([True], np.diff(rows[lead]) > 0))]], least, looked  # the smallest number among equals
        keep = part <= upper[rows]
        rows, cols, part = rows[keep], cols[keep], part[keep]


def first_centroids(blocks: DataFrame, count: int, dim: int, salt: str = SALT) -> np.ndarray:
    """The transformed vectors with the ``count`` smallest hashes of salt and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            for ids, x in zip(id_lists(batch), matrices(batch, dim), strict=True):
                hashes = [(hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), at)
                          for at, i in enumerate(ids.to_pylist()) if i is not None]
                near = heapq.nsmallest(count, hashes)
                far = near[-1][0] if near else ""
                tied = near + [h for h in hashes if h[0] == far and h not in near] if len(near) == count else near
                back = untransform(x[[at for _, at in tied]].astype(object)) // dim if tied else []
                best = heapq.nsmallest(count, best + [(h, [int(v) for v in row]) for (h, _), row in zip(tied, back, strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in best], pa.string()),
                                          pa.array([v for _, v in best], pa.list_(pa.int64()))], ["hash", "x"])

    rows = blocks.mapInArrow(run, "hash string, x array<long>").orderBy("hash", "x").limit(count).collect()
    return np.array([r["x"] for r in rows], object).reshape(len(rows), dim)


def cluster_sums(blocks: DataFrame, centroids: np.ndarray, dim: int) -> tuple[list[int], np.ndarray]:
    """(count, exact sum of the transformed vectors) of every cluster, by one pass."""
    k = len(centroids)
    shared = blocks.sparkSession.sparkContext.broadcast(transform(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), object)
        for batch in batches:
            for x in matrices(batch, dim):
                nearest, _, _ = progressive_nearest(x, shared.value)
                order = np.argsort(nearest, kind="stable")
                own, starts, counts = np.unique(nearest[order], return_index=True, return_counts=True)
                wide = x[order].astype(np.int64 if x.dtype.itemsize < 8 else object)
                total[own, 1:] += np.add.reduceat(wide, starts, axis=0).astype(object)
                total[own, 0] += counts.astype(object)
        flat = [Decimal(int(v)) for v in total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.decimal128(38, 0)))], ["part"])

    found = summed(blocks.select("ids", "width", "data").mapInArrow(run, "part array<decimal(38,0)>"))
    shared.destroy()
    found = np.array([int(v) for v in found], object).reshape(k, dim + 1)
    return [int(c) for c in found[:, 0]], found[:, 1:]


def fit(blocks: DataFrame, dim: int = DIM, count: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """The integer centroids after ``rounds`` rounds (a row each)."""
    centroids = first_centroids(blocks, count, dim)
    for _ in range(rounds if len(centroids) else 0):
        counts, sums = cluster_sums(blocks, centroids, dim)
        sums = untransform(sums) // dim  # exact: every sum of vectors is a whole number
        moved = [[int(s) // c for s in row] if c else list(old) for c, row, old in zip(counts, sums, centroids, strict=True)]
        centroids = np.array(moved, object)
    return centroids


def cluster(embeddings: DataFrame, dim: int = DIM, count: int = CENTROIDS, rounds: int = ROUNDS,
            scale: float = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every usable vector, as a written table; the final centroids)."""
    blocks = integer_blocks(embeddings, dim, scale, change=transform, name="walsh")
    centroids = fit(blocks, dim, count, rounds)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], ASSIGNED), centroids
    shared = embeddings.sparkSession.sparkContext.broadcast(transform(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in zip(id_lists(batch), matrices(batch, dim), strict=True):
                nearest, far, _ = progressive_nearest(x, shared.value)
                if far.dtype == object:
                    far = pa.array([Decimal(int(v) // dim) if v // dim < 10 ** 38 else None for v in far], pa.decimal128(38, 0))
                else:
                    far = pa.array(far // dim).cast(pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest, pa.int32()), far], ["vec_id", "cluster", "distance"])

    return written(blocks.mapInArrow(run, ASSIGNED), "clusters")[0], centroids


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per vector: cluster, distance, the inertia of its cluster and of all, and the digest of its centroid. The table
    joined to the vectors has one row per centroid."""
    spark = assigned.sparkSession
    hashes = spark.createDataFrame([(i, centroid_hash(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    own = assigned.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).collect()  # one row per centroid
    sums = [r["cluster_inertia"] for r in own]
    total = None if None in sums else sum(sums, Decimal(0))
    inertia = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], total) for r in own],
                                    "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0)")
    long = lambda c: F.expr(f"try_cast({c} AS long)").alias(c)
    return (assigned.join(F.broadcast(inertia.join(hashes, "cluster")), "cluster")
            .select("vec_id", "cluster", long("distance"), long("cluster_inertia"), long("inertia"), "centroid_sha256"))
