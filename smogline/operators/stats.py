"""Rank correlation and binned mutual information, distributed.

Spearman with pairwise-complete rows: the data is unpivoted to (pair, x, y) rows
for the pairs where both values exist and immediately pre-aggregated to a joint
(pair, x, y) -> count table. Average ranks come from the marginal counts (a
split running count over distinct values gives ``rank = rows before + (ties + 1) / 2``)
and are joined to the joint table, never to the raw rows; Pearson's r of the
ranks comes from count-weighted sums in one partial aggregation per pair (the
mean rank is (n+1)/2 by construction). No global sort into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.columns import round_half
from smogline.operators.profile import exact_quantiles, running_count


def _avg_ranks(joint: DataFrame, value: str, out: str) -> DataFrame:
    vc = running_count(joint.groupBy("pair", value).agg(F.sum("_c").alias("_c")), ["pair"], value)
    return vc.select("pair", value, (F.col("_before") + (F.col("_c") + F.lit(1)) / F.lit(2.0)).alias(out))


def spearman(df: DataFrame, cols: Sequence[str], digits: int = 6, target: str | None = None) -> DataFrame:
    """Long matrix (a, b, rho, n) for every unordered pair of ``cols`` (a < b in list order), or only for the pairs
    with ``target``."""
    pairs = [p for p in combinations(cols, 2) if target is None or target in p]
    rows = [F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
            for i, (a, b) in enumerate(pairs)]
    long = df.select(F.inline(F.array(*rows))).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    joint = long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("_c"))
    ranked = joint.join(_avg_ranks(joint, "x", "rx"), ["pair", "x"]).join(_avg_ranks(joint, "y", "ry"), ["pair", "y"])
    c, rx, ry = F.col("_c"), F.col("rx"), F.col("ry")
    sums = ranked.groupBy("pair").agg(F.sum(c * rx * ry).alias("sxy"), F.sum(c * rx * rx).alias("sxx"),
                                      F.sum(c * ry * ry).alias("syy"), F.sum(c).alias("n"))
    # average ranks of n rows always sum to n(n+1)/2, so the centring term is n * ((n+1)/2)^2
    centre = F.col("n").cast("double") * ((F.col("n") + F.lit(1)) / F.lit(2.0)) ** 2
    rho = sums.select("pair", round_half(F.try_divide(F.col("sxy") - centre, F.sqrt(
        (F.col("sxx") - centre) * (F.col("syy") - centre))), digits).alias("rho"), "n")
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    return rho.select(F.get(names, F.col("pair")).getField("a").alias("a"),
                      F.get(names, F.col("pair")).getField("b").alias("b"), "rho", "n")


def rank_by_abs(corr: DataFrame, target: str) -> DataFrame:
    """Features ordered by |rho| with ``target`` (rank 1 = strongest)."""
    t = corr.filter((F.col("a") == target) | (F.col("b") == target)).select(
        F.when(F.col("a") == target, F.col("b")).otherwise(F.col("a")).alias("feature"), "rho")
    return t.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("rho").desc(), "feature")))


def binned_mutual_info(df: DataFrame, features: Sequence[str], target: str, bins: int = 10,
                       digits: int = 6) -> DataFrame:
    """MI (nats) between each feature and the target on equal-frequency bins.

    Bin edges are exact quantiles; bin = number of edges strictly below the value.
    Joint and marginal counts are plain aggregates over the unpivoted rows.
    """
    probs = [i / bins for i in range(1, bins)]
    names = [f"e{i}" for i in range(1, bins)]
    cols = list(features) + [target]
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"), F.col(target).cast("double").alias("t"))
        for c in cols])))
    long = long.filter(F.col("v").isNotNull() & F.col("t").isNotNull())
    # (features + 1) x (bins - 1) edge values: fetched once, applied as literals (no join)
    edges = {r["column"]: [r[n] for n in names]
             for r in exact_quantiles(long, ["column"], "v", probs, names).collect()}
    emap = F.create_map(*[x for c, e in edges.items() for x in (F.lit(c), F.array(*[F.lit(v) for v in e]))])
    mine = F.element_at(emap, F.col("column"))
    binned = long.withColumn("bx", sum((F.col("v") > F.get(mine, i)).cast("int") for i in range(len(names))))
    binned = binned.withColumn("by", sum((F.col("t") > F.lit(v)).cast("int") for v in edges[target]))
    joint = binned.groupBy("column", "bx", "by").agg(F.count(F.lit(1)).alias("nxy"))
    w = Window.partitionBy("column")
    joint = joint.withColumn("n", F.sum("nxy").over(w)) \
        .withColumn("nx", F.sum("nxy").over(Window.partitionBy("column", "bx"))) \
        .withColumn("ny", F.sum("nxy").over(Window.partitionBy("column", "by")))
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    mi = joint.groupBy("column").agg(round_half(F.sum(term), digits).alias("mutual_info"))
    return mi.filter(F.col("column") != target).withColumnRenamed("column", "feature").withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("mutual_info").desc(), "feature")))
