"""Gradient-boosted forecast (MLlib) and per-row tree contributions.

Training uses MLlib's distributed ``GBTRegressor`` with a validation indicator
column (early stopping on the validation split). Contributions are exact Shapley values of
the trees: a feature that is left out follows both branches of its splits, weighted by
their training rows. They add up: ``base + sum(contributions) == prediction``.

On the way to a leaf, feature g has a share z_g (of training rows that its splits let through) and a bit o_g (the row's
value passes all of them). The leaf's value times (o_f - z_f) times the weighted coefficients of the polynomial
prod (z_g + o_g y) over the other features on the way is its part of f's contribution, with weight
k! (d - k - 1)! / d! for y^k and d features: polynomial time in place of all subsets. A leaf has few distinct bit
patterns, so a batch of rows computes one small table per leaf and looks its rows up.

The trees are read from the model's saved node table (MLlib's own persistence
format), collected once (bounded by iterations x nodes per tree) and broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import scratch_path, ship_package


def train_gbt(df: DataFrame, features: Sequence[str], label: str = "aqi_target", val_col: str = "is_val",
              max_iter: int = 60, max_depth: int = 5, step: float = 0.1, subsample: float = 0.8,
              seed: int = 42) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       validationIndicatorCol=val_col, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
                       subsamplingRate=subsample, seed=seed)
    return Pipeline(stages=[assembler, gbt]).fit(df)


class TreeEnsemble:
    """Flattened trees: per node feature, threshold, children, mean and training rows; per tree weight and root."""

    def __init__(self, nodes: pd.DataFrame, weights: Sequence[float]):
        nodes = nodes.sort_values(["treeID", "id"]).reset_index(drop=True)
        counts = nodes.groupby("treeID").size()
        starts = np.concatenate([[0], np.cumsum(counts.to_numpy())[:-1]])
        offset = dict(zip(counts.index.to_numpy(), starts))
        # node ids are dense 0..k-1 within a tree in the saved format
        off = nodes["treeID"].map(offset).to_numpy(np.int64)
        self.roots = np.array([offset[t] for t in sorted(offset)], dtype=np.int64)
        self.tree_weight = np.asarray(weights, dtype=float)[np.array(sorted(offset))]
        self.weight_of_node = np.asarray(weights, dtype=float)[nodes["treeID"].to_numpy()]
        self.left = np.where(nodes["leftChild"] >= 0, nodes["leftChild"].to_numpy(np.int64) + off, -1)
        self.right = np.where(nodes["rightChild"] >= 0, nodes["rightChild"].to_numpy(np.int64) + off, -1)
        self.feature = nodes["featureIndex"].to_numpy(np.int64)
        self.threshold = nodes["threshold"].to_numpy(float)
        self.mean = nodes["prediction"].to_numpy(float)
        self.cover = nodes["cover"].to_numpy(float)
        self.leaves = [leaf for r, w in zip(self.roots, self.tree_weight, strict=True) for leaf in self._leaves(int(r), float(w))]
        self.base = float(sum(leaf.value * np.prod(leaf.share) for leaf in self.leaves))

    def _leaves(self, root: int, weight: float) -> list[Leaf]:
        """The leaves of a tree with the features on the way to them."""
        found, waiting = [], [(root, ())]
        while waiting:
            node, way = waiting.pop()
            if self.left[node] < 0:
                names = sorted({int(self.feature[n]) for n, _ in way})
                share, splits = np.ones(len(names)), [[] for _ in names]
                for n, left in way:
                    i = names.index(int(self.feature[n]))
                    child = self.left[n] if left else self.right[n]
                    share[i] *= self.cover[child] / self.cover[n]
                    splits[i].append((float(self.threshold[n]), left))
                found.append(Leaf(weight * float(self.mean[node]), names, share, splits))
            else:
                waiting += [(int(self.left[node]), (*way, (node, True))), (int(self.right[node]), (*way, (node, False)))]
        return found

    def contributions(self, x: np.ndarray) -> np.ndarray:
        """The Shapley values (rows, features) of a batch."""
        out = np.zeros(x.shape)
        for leaf in self.leaves:
            code = np.zeros(len(x), np.int64)
            for i, (name, splits) in enumerate(zip(leaf.features, leaf.splits, strict=True)):
                passed = np.ones(len(x), bool)
                for threshold, left in splits:
                    passed &= (x[:, name] <= threshold) == left
                code |= passed.astype(np.int64) << i
            patterns, of = np.unique(code, return_inverse=True)
            bits = (patterns[:, None] >> np.arange(len(leaf.features))) & 1
            out[:, leaf.features] += leaf.value * shapley_table(leaf.share, bits.astype(float))[of]
        return out


@dataclass
class Leaf:
    """A leaf's weighted value, and per feature on the way to it: the share of training rows its splits let through, and
    the splits (threshold, whether the way goes left)."""

    value: float
    features: list[int]
    share: np.ndarray
    splits: list[list[tuple[float, bool]]]


def shapley_table(share: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Shapley values (patterns, features) of a leaf of value 1 for each pattern of passed features."""
    d = len(share)
    weights = np.array([math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)])
    out = np.zeros(bits.shape)
    for f in range(d):
        terms = np.zeros((len(bits), d))  # coefficients of the polynomial over the other features
        terms[:, 0] = 1
        for g in range(d):
            if g != f:
                raised = np.concatenate((np.zeros((len(bits), 1)), terms[:, :-1]), 1)
                terms = share[g] * terms + bits[:, g:g + 1] * raised
        out[:, f] = (bits[:, f] - share[f]) * (terms @ weights)
    return out


def load_ensemble(spark: SparkSession, model: PipelineModel) -> TreeEnsemble:
    gbt = model.stages[-1]
    path = scratch_path(spark, "gbt-model")
    gbt.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.rawCount").alias("cover"),
        F.col("nodeData.split.featureIndex").alias("featureIndex"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold"))
    return TreeEnsemble(data.toPandas(), list(gbt.treeWeights))


def contributions(spark: SparkSession, df: DataFrame, model: PipelineModel, features: Sequence[str],
                  keys: Sequence[str]) -> DataFrame:
    """Long table (keys..., feature, value, contribution) plus one '__base__' row per input row."""
    ship_package(spark)
    ens = load_ensemble(spark, model)
    bc = spark.sparkContext.broadcast(ens)
    feats, keys = list(features), list(keys)
    key_fields = [df.schema[k] for k in keys]
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType(key_fields + [StructField("feature", StringType()), StructField("value", DoubleType()),
                                      StructField("contribution", DoubleType())])

    def run(batches):
        e = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf[feats].to_numpy(dtype=float)
            c = e.contributions(x)
            m, k = c.shape
            long = pd.DataFrame({kk: np.repeat(pdf[kk].to_numpy(), k + 1) for kk in keys})
            long["feature"] = np.tile(np.array(feats + ["__base__"], dtype=object), m)
            long["value"] = np.concatenate([x, np.full((m, 1), np.nan)], axis=1).reshape(-1)
            long["contribution"] = np.concatenate([c, np.full((m, 1), e.base)], axis=1).reshape(-1)
            yield long

    return df.select(*keys, *feats).mapInPandas(run, schema)


def importance(contrib: DataFrame, keys: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """Mean |contribution| per feature (optionally per key), ranked."""
    from pyspark.sql import Window

    c = contrib.filter(F.col("feature") != "__base__")
    agg = c.groupBy(*keys, "feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
    w = Window.partitionBy(*keys).orderBy(F.col("mean_abs_contribution").desc(), "feature") if keys \
        else Window.orderBy(F.col("mean_abs_contribution").desc(), "feature")
    out = agg.withColumn("rank", F.row_number().over(w))
    return out.filter(F.col("rank") <= top) if top else out


def waterfall(contrib: DataFrame, row_filter, top: int = 10) -> DataFrame:
    """One row's explanation: base, the ``top`` largest |contribution| features, and the sum of all others, so that
    the rows add up to the prediction."""
    from pyspark.sql import Window

    one = contrib.filter(row_filter)
    w = Window.orderBy(F.abs("contribution").desc(), "feature")
    feats = one.filter(F.col("feature") != "__base__").withColumn("rank", F.row_number().over(w))
    keys = [c for c in one.columns if c not in ("feature", "value", "contribution")]
    other = feats.filter(F.col("rank") > top).groupBy(*keys).agg(
        F.lit("__other__").alias("feature"), F.lit(None).cast("double").alias("value"),
        F.sum("contribution").alias("contribution"), F.lit(top + 1).alias("rank"))
    base = one.filter(F.col("feature") == "__base__").withColumn("rank", F.lit(0))
    return base.unionByName(feats.filter(F.col("rank") <= top)).unionByName(other)


def labelled(contrib: DataFrame) -> DataFrame:
    """Feature-value/contribution pairs with the features' display labels (their names where there is none)."""
    from smogline import constants as K
    from smogline.functions.columns import label_lookup

    return contrib.withColumn("label", F.coalesce(label_lookup("feature", K.FEATURE_LABELS), F.col("feature")))
