"""Isolation forest as a Spark job.

1. Sample: every row gets a seeded ``xxhash64`` of its key; each tree receives at
   most ``max_samples`` rows (the smallest hashes among its candidates), so the
   sample is repeatable across partitionings and bounded per tree.
2. Fit: ``groupBy(tree_id).applyInPandas`` grows one tree per group (trees in
   parallel; a group never holds more than ``max_samples`` rows).
3. Score: the forest (bounded: trees x (2 * max_samples - 1) nodes) is broadcast
   and ``mapInPandas`` computes path lengths for Arrow batches with numpy.
4. Threshold: ``percentile_approx`` of the scores (bounded memory), flag above it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import checkpoint_dir, ship_package

_EULER = 0.5772156649015329
NODE_SCHEMA = "tree_id int, node_id int, feature int, threshold double, left int, right int, size int"


def c_factor(n):
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + _EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes (node_id, feature, threshold, left, right, size) in pre-order."""
    nodes: list[list] = []

    def build(idx: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, int(idx.size)])
        if depth >= max_depth or idx.size <= 1:
            return me
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return me
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        nodes[me][1:5] = [f, thr, left, right]
        return me

    build(np.arange(x.shape[0]), 0)
    return [tuple(n) for n in nodes]


def _unit(h: F.Column) -> F.Column:
    """A 64-bit hash mapped to [0, 1)."""
    return h.bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF)) / F.lit(float(2 ** 63))


def sample_for_trees(df: DataFrame, key_cols: Sequence[str], features: Sequence[str], n_trees: int = 200,
                     max_samples: int = 256, seed: int = 42, oversample: float = 3.0, n: int | None = None,
                     pool_rows: int = 20_000) -> DataFrame:
    """(tree_id, features...) with at most ``max_samples`` rows per tree.

    One rule at every size: a seeded pool of about ``pool_rows`` rows (all rows, if there are fewer), from which
    every tree draws the ``psi`` rows with the smallest (row, tree) hash. A hash threshold keeps only about
    ``oversample * psi`` candidates per tree before the ranking (exact: if a tree is left with fewer than ``psi``,
    the draw is made without the threshold). The pool bounds the (row, tree) expansion whatever the table's size.
    """
    from pyspark.sql import Window

    n = df.count() if n is None else n
    base = df.select(*features, F.xxhash64(*key_cols, F.lit(seed)).alias("_h"))
    pool = base.filter(_unit(F.xxhash64("_h", F.lit(seed + 1))) < min(1.0, pool_rows / max(n, 1)))
    psi = min(max_samples, n)
    frac = min(1.0, oversample * psi / max(min(n, pool_rows), 1))
    every = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id"))
    every = every.withColumn("_r", _unit(F.xxhash64("_h", "tree_id", F.lit(seed))))
    cand = every.filter(F.col("_r") < frac)
    if cand.groupBy("tree_id").count().filter(F.col("count") >= psi).count() < n_trees:
        cand = every
    w = Window.partitionBy("tree_id").orderBy("_r", "_h")
    return cand.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= psi).drop("_k", "_r", "_h")


def fit_forest(samples: DataFrame, features: Sequence[str], max_samples: int = 256, seed: int = 42) -> DataFrame:
    """One tree per tree_id group; returns the node table."""
    ship_package(samples.sparkSession)
    feats = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tid = int(pdf["tree_id"].iloc[0])
        x = pdf[feats].to_numpy(dtype=float)
        depth = int(math.ceil(math.log2(max(max_samples, 2))))
        rng = np.random.default_rng([seed, tid])
        rows = _grow(x, rng, depth)
        out = pd.DataFrame(rows, columns=["node_id", "feature", "threshold", "left", "right", "size"])
        out.insert(0, "tree_id", tid)
        return out.astype({"tree_id": "int32", "node_id": "int32", "feature": "int32", "left": "int32",
                           "right": "int32", "size": "int32"})

    return samples.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


class Forest:
    """Flattened node arrays of all trees (offsets per tree), ready to broadcast."""

    def __init__(self, nodes: pd.DataFrame, psi: int):
        nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
        counts = nodes.groupby("tree_id").size().to_numpy()
        self.roots = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        off = np.repeat(self.roots, counts)
        self.feature = nodes["feature"].to_numpy(np.int64)
        self.threshold = nodes["threshold"].to_numpy(float)
        self.left = np.where(nodes["left"] >= 0, nodes["left"].to_numpy(np.int64) + off, -1)
        self.right = np.where(nodes["right"] >= 0, nodes["right"].to_numpy(np.int64) + off, -1)
        self.leaf_adj = c_factor(nodes["size"].to_numpy())
        self.psi = psi

    def scores(self, x: np.ndarray) -> np.ndarray:
        m, t = x.shape[0], self.roots.size
        node = np.tile(self.roots, (m, 1))
        depth = np.zeros((m, t))
        rows = np.arange(m)[:, None]
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                break
            xv = x[np.broadcast_to(rows, node.shape), np.where(inner, f, 0)]
            nxt = np.where(xv < self.threshold[node], self.left[node], self.right[node])
            node = np.where(inner, nxt, node)
            depth += inner
        path = depth + self.leaf_adj[node]
        return np.power(2.0, -path.mean(axis=1) / c_factor([self.psi])[0])


def score(spark: SparkSession, df: DataFrame, nodes: DataFrame, features: Sequence[str], psi: int,
          out: str = "iforest_score") -> DataFrame:
    """Append the anomaly score in (0, 1] (higher = more isolated) to every row."""
    ship_package(spark)
    forest = Forest(nodes.toPandas(), psi)  # bounded by n_trees * (2 * psi - 1) rows
    bc = spark.sparkContext.broadcast(forest)
    feats = list(features)
    from pyspark.sql.types import DoubleType, StructField, StructType

    schema = StructType(list(df.schema.fields) + [StructField(out, DoubleType())])

    def run(batches):
        fo = bc.value
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            pdf[out] = fo.scores(x) if len(pdf) else np.zeros(0)
            yield pdf

    return df.mapInPandas(run, schema)


def flag(scored: DataFrame, contamination: float = 0.02, col: str = "iforest_score",
         name: str = "is_anom_iforest", accuracy: int = 100000) -> DataFrame:
    """Flag the top ``contamination`` share of scores (threshold by ``percentile_approx``)."""
    thr = scored.agg(F.percentile_approx(col, 1.0 - contamination, accuracy).alias("t")).first()["t"]
    return scored.withColumn(name, (F.col(col) > F.lit(thr)).cast("int"))


def thresholds(scored: DataFrame, rates: Sequence[float], col: str = "iforest_score",
               accuracy: int = 100000) -> list[float]:
    row = scored.agg(F.percentile_approx(col, [1.0 - r for r in rates], accuracy).alias("t")).first()
    return list(row["t"])


def isolation_forest(spark: SparkSession, df: DataFrame, key_cols: Sequence[str], features: Sequence[str],
                     n_trees: int = 200, max_samples: int = 256, contamination: float = 0.02, seed: int = 42,
                     standardize: bool = True) -> DataFrame:
    """Score and flag every row of ``df`` (rows with a null feature are dropped first)."""
    from smogline.operators import ml

    data = df.na.drop(subset=list(features))
    feats = list(features)
    if standardize:
        stats = ml.fit_scaler(data, feats)
        data = ml.apply_scaler(data, stats, digits=12, suffix="__s")
        feats = [f"{c}__s" for c in features]
    data = data.persist()
    n = data.count()
    psi = min(max_samples, n)
    nodes = fit_forest(sample_for_trees(data, key_cols, feats, n_trees, max_samples, seed, n=n), feats, max_samples, seed)
    # scores feed two passes (threshold, flag): write them once to the shared checkpoint
    # folder, which also cuts the lineage back to the Python stages
    checkpoint_dir(spark)
    scored = score(spark, data, nodes, feats, psi).checkpoint(eager=True)
    data.unpersist()
    return flag(scored, contamination).drop(*[c for c in feats if c.endswith("__s")])
