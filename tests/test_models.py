"""Invariants of the custom model jobs (isolation forest, tree contributions)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.operators import iforest


def test_iforest_outlier_scores_higher_and_bounded(spark):
    rng = np.random.default_rng(0)
    train = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(50, 10, size=(100, 2)))]
    df = spark.createDataFrame(train + [(1000, 50.0, 40.0), (1001, 500.0, 450.0)], "id int, aqi double, pm25 double")
    out = iforest.isolation_forest(spark, df, ["id"], ["aqi", "pm25"], n_trees=100, max_samples=64,
                                   contamination=0.02, standardize=False)
    s = {r.id: r.iforest_score for r in out.collect()}
    assert s[1001] > s[1000]
    assert all(0 < v <= 1 for v in s.values())
    assert out.filter(F.col("id") == 1001).first().is_anom_iforest == 1
    share = out.agg(F.avg("is_anom_iforest")).first()[0]
    assert share <= 0.05


def test_iforest_sampling_is_repeatable(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("x"))
    a = iforest.sample_for_trees(df, ["id"], ["x"], n_trees=10, max_samples=32, seed=7)
    b = iforest.sample_for_trees(df.repartition(7), ["id"], ["x"], n_trees=10, max_samples=32, seed=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.groupBy("tree_id").count().agg(F.max("count")).first()[0] == 32


def test_contributions_are_additive(spark):
    from smogline.operators import forecast

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(scale=0.1, size=300)
    rows = [(i, float(a), float(b), float(c), float(t), i % 5 == 0) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, f0 double, f1 double, f2 double, aqi_target double, is_val boolean")
    feats = ["f0", "f1", "f2"]
    model = forecast.train_gbt(df, feats, max_iter=10, max_depth=3)
    pred = {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}
    contrib = forecast.contributions(spark, df, model, feats, ["id"])
    total = {r.id: r.s for r in contrib.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    assert all(abs(total[i] - pred[i]) < 1e-6 for i in pred)
    imp = forecast.importance(contrib).orderBy("rank").first()
    assert imp.feature == "f0"


def test_waterfall_rows_add_up(spark):
    from smogline.operators import forecast

    rows = [(1, "__base__", None, 5.0)] + [(1, f"f{i}", float(i), (-1) ** i * i / 10) for i in range(1, 16)]
    c = spark.createDataFrame(rows, "k int, feature string, value double, contribution double")
    w = forecast.waterfall(c, F.col("k") == 1, top=4).orderBy("rank").collect()
    assert [r.feature for r in w] == ["__base__", "f15", "f14", "f13", "f12", "__other__"]
    assert abs(sum(r.contribution for r in w) - sum(r[3] for r in rows)) < 1e-9
    assert forecast.labelled(c.withColumn("feature", F.lit("pm25"))).first().label == "PM2.5"


def test_forest_samples_by_one_rule_at_every_size(spark):
    """Every tree draws its rows from one pool, whether the table is smaller or larger than the pool."""
    df = spark.range(4000).select("id", (F.col("id") * 1.0).alias("x"))
    drawn = []
    for pool in (2000, 50_000):
        rows = iforest.sample_for_trees(df, ["id"], ["x"], n_trees=20, max_samples=64, pool_rows=pool).collect()
        sizes = {}
        for r in rows:
            sizes.setdefault(r.tree_id, []).append(r.x)
        assert len(sizes) == 20 and all(len(v) == len(set(v)) == 64 for v in sizes.values())
        drawn.append(len(set(r.x for r in rows)))
    assert all(n < 20 * 64 for n in drawn)  # trees overlap in both cases


def test_overlap_shares(spark):
    from smogline.operators import ml

    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (1, 1), (None, 0)], "a int, b int")
    assert ml.overlap(df, "a", "b").first().asDict() == {"n_a": 3, "n_b": 3, "n_both": 2, "share_of_a": 2 / 3, "share_of_b": 2 / 3}
    assert ml.overlap(df.limit(0), "a", "b").first().share_of_a is None


def test_contributions_equal_subset_enumeration(spark):
    """Shapley values by their definition on a model of six features: every subset, left-out features by training rows."""
    from itertools import combinations
    from math import factorial

    from smogline.operators import forecast

    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 6))
    y = 3 * x[:, 0] * (x[:, 1] > 0) - 2 * np.abs(x[:, 2]) + x[:, 3] * x[:, 4] + rng.normal(scale=0.1, size=500)
    feats = [f"f{i}" for i in range(6)]
    rows = [(i, *map(float, r), float(t), i % 5 == 0) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{f} double" for f in feats) + ", aqi_target double, is_val boolean")
    model = forecast.train_gbt(df, feats, max_iter=6, max_depth=4)
    ens = forecast.load_ensemble(spark, model)

    def expected(row, subset, node):
        if ens.left[node] < 0:
            return ens.mean[node]
        left, right = int(ens.left[node]), int(ens.right[node])
        if int(ens.feature[node]) in subset:
            return expected(row, subset, left if row[ens.feature[node]] <= ens.threshold[node] else right)
        return sum(ens.cover[c] * expected(row, subset, c) for c in (left, right)) / ens.cover[node]

    def value(row, subset):
        return sum(w * expected(row, subset, int(r)) for r, w in zip(ens.roots, ens.tree_weight, strict=True))

    got = ens.contributions(x[:12])
    for row, mine in zip(x[:12], got, strict=True):
        for f in range(6):
            others = [g for g in range(6) if g != f]
            want = sum(factorial(k) * factorial(5 - k) / factorial(6) * (value(row, {*s, f}) - value(row, set(s)))
                       for k in range(6) for s in combinations(others, k))
            assert mine[f] == pytest.approx(want, abs=1e-9)
        assert ens.base + mine.sum() == pytest.approx(value(row, set(range(6))), abs=1e-9)
    assert ens.base == pytest.approx(value(x[0], set()), abs=1e-9)
