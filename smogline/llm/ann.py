"""Approximate nearest neighbours with balanced posting lists.

A bounded sample (``sample_rows``) gives about sqrt(n) centroids, kept balanced by halving clusters at the median and
by a size penalty in the refinement. Every vector joins the posting list of its nearest centroid and, if it lies near
a boundary, those of up to ``replicas`` - 1 further ones (distance within 1 + ``boundary`` of the nearest). A query
walks a neighbour graph of the centroids held in memory and takes the lists whose centroid is within 1 + ``ratio`` of
the nearest (of the nearest few, where the first hold less than ``k`` candidates). Inner products become distances by one extra component that brings
every vector to the largest norm.

Lists and the queries that visit them are cut into blocks of bounded length, so neither a hot vector nor a popular
list is one task. The nearest lists are searched first; the k-th score found there bounds what the other lists report. A block reports
its k best distinct ids, each by its best row, so repeated rows take no other id's place.
Scores are inner products of the original vectors in double precision.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those
whose dimension isn't the most frequent one (the smaller on a tie); rows with equal ids count once and never find
each other; equal scores go to the smaller id; with fewer than k other vectors all are returned; an empty table gives
an empty result; only the id and the vector are read.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import hash_sample, prepare, written

K = 20
SAMPLE_ROWS = 20_000
MAX_CENTROIDS = 4096
REPLICAS = 4
BOUNDARY = 0.05
RATIO = 0.20
#: Lists of the first search, and the longest block of a list or of its queries.
FIRST_LISTS = 4
BLOCK = 4096
DEGREE = 16


@dataclass
class Centroids:
    points: np.ndarray
    neighbours: list[np.ndarray]
    entry: int
    largest: float
    sizes: np.ndarray | None = None

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors scaled by the largest norm, with the component that makes all of length one."""
        x = vectors / self.largest
        rest = np.sqrt(np.maximum(1 - (x * x).sum(1), 0))
        return np.concatenate((x, rest[:, None]), 1)

    def lists_of(self, vectors: np.ndarray, boundary: float, replicas: int) -> list[np.ndarray]:
        """The posting lists of each vector, the nearest centroid's first."""
        x = self.extended(vectors)
        d = np.sqrt(np.maximum(1 + (self.points ** 2).sum(1) - 2 * x @ self.points.T, 0))
        m = min(replicas, d.shape[1])
        near = np.argsort(d, axis=1, kind="stable")[:, :m]
        far = np.take_along_axis(d, near, 1)
        keep = far <= (1 + boundary) * far[:, :1] + 1e-12
        return [n[k] for n, k in zip(near, keep, strict=True)]

    def visit(self, query: np.ndarray, ratio: float, least: int) -> list[int]:
        """Lists to search, nearest first: best-first walk on the graph until the next centroid is farther than
        1 + ratio times the nearest ones that hold ``least`` vectors."""
        norm = np.linalg.norm(query)
        q = np.append(query / norm, 0.0)
        distance = lambda c: np.sqrt(np.maximum(1 + (self.points[c] ** 2).sum(-1) - 2 * self.points[c] @ q, 0))
        seen = np.zeros(len(self.points), bool)
        seen[self.entry] = True
        heap = [(float(distance(self.entry)), self.entry)]
        met: list[tuple[float, int]] = []  # ascending

        def reach() -> float:
            held = 0
            for d, c in met:
                held += int(self.sizes[c])
                if held >= least:
                    return (1 + ratio) * d + 1e-12
            return math.inf

        while heap and heap[0][0] <= reach():
            d, c = heapq.heappop(heap)
            bisect.insort(met, (d, c))
            new = self.neighbours[c][~seen[self.neighbours[c]]]
            seen[new] = True
            for e, n in zip(np.atleast_1d(distance(new)).tolist(), new.tolist(), strict=True):
                heapq.heappush(heap, (e, n))
        limit = reach()
        return [c for d, c in met if d <= limit]


def balanced_centroids(x: np.ndarray, count: int, rounds: int = 6, penalty: float = 0.1) -> np.ndarray:
    """``count`` centroids of the rows: halve the largest cluster at the median of its widest random direction, then
    refine by nearest centroid with a penalty on large clusters."""
    rng = np.random.default_rng(5)
    parts = [np.arange(len(x))]
    while len(parts) < min(count, len(x)):
        parts.sort(key=len)
        own = parts.pop()
        y = x[own]
        a, b = y[rng.integers(len(y))], y[rng.integers(len(y))]
        order = np.argsort(y @ (a - b) if np.any(a != b) else np.arange(len(y)), kind="stable")
        parts += [own[order[:len(own) // 2]], own[order[len(own) // 2:]]]
    c = np.array([x[p].mean(0) for p in parts if len(p)])
    size = np.full(len(c), len(x) / len(c))
    for _ in range(rounds):
        d = (c * c).sum(1) - 2 * x @ c.T
        near = (d + penalty * size / size.mean()).argmin(1)
        size = np.bincount(near, minlength=len(c)).astype(float)
        for j in np.flatnonzero(size):
            c[j] = x[near == j].mean(0)
    return c


def neighbour_graph(c: np.ndarray, degree: int = DEGREE) -> list[np.ndarray]:
    """Each centroid's nearest ones, both ways, plus a link to its nearest predecessor, which keeps all reachable."""
    d = (c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T
    np.fill_diagonal(d, np.inf)
    links: list[set[int]] = [set() for _ in c]
    for i in range(len(c)):
        near = np.argsort(d[i], kind="stable")[:degree].tolist()
        if len(c) == 1:
            near = []
        if i:
            near.append(int(d[i, :i].argmin()))
        for j in near:
            links[i].add(j)
            links[j].add(i)
    return [np.array(sorted(s), np.int64) for s in links]


def usable(embeddings: DataFrame) -> tuple[DataFrame, Column]:
    """(vec_id, vec as doubles) of the vectors that take part so far, and their squared norm."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", fine)
                       & F.exists("vec", lambda x: x != 0))
    return rows, F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def search(embeddings: DataFrame, query_filter: Column, k: int = K, sample_rows: int = SAMPLE_ROWS,
           boundary: float = BOUNDARY, replicas: int = REPLICAS, ratio: float = RATIO, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that meets ``query_filter`` on vec_id."""
    spark = embeddings.sparkSession
    prepare(spark)
    result = "query_id long, vec_id long, score double"
    rows, norm = usable(embeddings)
    shape = (rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"))
             .orderBy(F.desc("n"), "dim").first())
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, n = rows.filter(F.size("vec") == shape["dim"]), shape["n"]
    sample = hash_sample(rows, "vec_id", sample_rows, n, "lists").toArrow().sort_by("vec_id")
    model = Centroids(np.empty((0, 0)), [], 0, math.sqrt(shape["largest"]) * (1 + 1e-12))
    x = model.extended(_matrix(sample.column("vec")) if sample.num_rows else np.zeros((1, shape["dim"])))
    model.points = balanced_centroids(x, min(MAX_CENTROIDS, math.ceil(math.sqrt(n))))
    model.neighbours = neighbour_graph(model.points)
    model.entry = int(((model.points - model.points.mean(0)) ** 2).sum(1).argmin())
    shared = spark.sparkContext.broadcast(model)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = shared.value.lists_of(_matrix(batch.column("vec")), boundary, replicas)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                                                 ["vec_id", "vec", "lists"])

    placed, _ = written(rows.mapInArrow(place, "vec_id long, vec array<double>, lists array<int>"), "postings")
    once = placed.groupBy("vec_id").agg(F.min(F.element_at("lists", 1)).alias("list"))
    counts = once.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()
    model.sizes = np.zeros(len(model.points), np.int64)  # one first placement only: each id counts once
    for r in counts:
        model.sizes[r["list"]] = r["n"]
    walked = spark.sparkContext.broadcast(model)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = [walked.value.visit(q, ratio, 2 * k + 1) for q in _matrix(batch.column("vec"))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                                                 ["query_id", "vec", "lists"])

    asked = rows.filter(query_filter).select(F.col("vec_id").alias("query_id"), "vec")
    queries, _ = written(asked.mapInArrow(walk, "query_id long, vec array<double>, lists array<int>"), "queries")

    members = placed.withColumn("list", F.explode("lists")).drop("lists")
    blocks = members.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))

    def compare(key, questions, vectors):
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.float64())})
        if not questions.num_rows or not vectors.num_rows:
            return empty
        ids, v = vectors.column("vec_id").to_numpy(), _matrix(vectors.column("vec"))
        order = np.argsort(ids, kind="stable")
        ids, v = ids[order], v[order]
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))  # the rows of each distinct id
        distinct = ids[starts]
        q_ids, least = questions.column("query_id").to_numpy(), questions.column("least").to_numpy()
        q_all = _matrix(questions.column("vec"))
        out_q, out_v, out_s = [], [], []
        for at in range(0, len(q_ids), 256):
            q = q_all[at:at + 256]
            s = q @ v.T
            for i in range(len(q)):
                mine = s[i]
                others = ids != q_ids[at + i]
                tops = mine if len(distinct) == len(ids) else np.maximum.reduceat(mine, starts)
                tops = tops[distinct != q_ids[at + i]]
                room = 1e-9 * max(1.0, float(np.abs(mine).max()))
                floor = least[at + i]
                if len(tops) > k:
                    floor = max(floor, np.partition(tops, -k)[-k])
                near = np.flatnonzero(others & (mine >= floor - room))
                exact = (v[near] * q[i]).sum(1)
                best = np.lexsort((ids[near], -exact))
                if len(distinct) < len(ids):  # the best row of each id
                    best = best[np.sort(np.unique(ids[near][best], return_index=True)[1])]
                best = best[:k]
                out_q.append(np.full(len(best), q_ids[at + i]))
                out_v.append(ids[near][best])
                out_s.append(exact[best])
        return pa.table({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})

    def run(asked: DataFrame) -> DataFrame:
        """Candidates of (query_id, vec, list, least): blocks of a list against blocks of its queries."""
        visits = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("turns"))
        plan = blocks.join(visits, "list")
        part = lambda key, of: F.pmod(F.xxhash64(key), F.col(of)).cast("int")
        every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        left = (asked.join(plan, "list").withColumn("turn", part("query_id", "turns")).withColumn("block", every("blocks"))
                .select("list", "block", "turn", "query_id", "vec", "least"))
        right = (members.join(plan, "list").withColumn("block", part("vec_id", "blocks")).withColumn("turn", every("turns"))
                 .select("list", "block", "turn", "vec_id", "vec"))
        key = ("list", "block", "turn")
        return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, result)

    def top(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k))

    low = F.lit(float("-inf"))
    near = queries.withColumn("list", F.explode(F.slice("lists", 1, FIRST_LISTS))).withColumn("least", low).drop("lists")
    first, _ = written(top(run(near)).select("query_id", "vec_id", "score"), "first")
    bound = first.groupBy("query_id").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    rest = (queries.filter(F.size("lists") > FIRST_LISTS).join(bound, "query_id", "left")
            .withColumn("least", F.when(F.col("n") >= k, F.col("low")).otherwise(low))
            .withColumn("list", F.explode(F.slice("lists", FIRST_LISTS + 1, 1 << 30)))
            .select("query_id", "vec", "list", "least"))
    return (top(first.unionByName(run(rest))).select("query_id", "rank", "vec_id", "score"))
