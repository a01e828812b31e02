"""Brute-force checks of window/statistics operators against pandas on small random fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from smogline.operators import profile, stats, windows as W

T0 = dt.datetime(2024, 1, 1)


def _series(seed, n=120, null_share=0.3, cities=("a", "b")):
    rng = np.random.default_rng(seed)
    rows = []
    for c in cities:
        vals = np.round(rng.uniform(0, 300, n), 2)
        vals[rng.random(n) < null_share] = np.nan
        # runs of missing values of various lengths
        for start in rng.integers(0, n - 10, 3):
            vals[start:start + rng.integers(1, 10)] = np.nan
        rows += [(c, T0 + dt.timedelta(hours=i), None if np.isnan(v) else float(v)) for i, v in enumerate(vals)]
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interpolate_matches_pandas_time_limit(spark, seed):
    rows = _series(seed)
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, aqi double")
    got = {(r.queried_city, r.measured_at): r.aqi for r in W.interpolate(df, ["aqi"], limit=6).collect()}
    pdf = pd.DataFrame(rows, columns=["city", "ts", "aqi"])
    for c, g in pdf.groupby("city"):
        s = g.set_index("ts")["aqi"].astype(float).interpolate(method="time", limit=6)
        for ts, v in s.items():
            mine = got[(c, ts.to_pydatetime())]
            if np.isnan(v):
                assert mine is None, (c, ts)
            else:
                assert mine == pytest.approx(v, abs=1e-6), (c, ts)


@pytest.mark.parametrize("window,min_periods", [(3, None), (24, "full"), (7, "half")])
def test_trailing_rolling_matches_pandas(spark, window, min_periods):
    rows = _series(7, null_share=0.1)
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, aqi double")
    w = W._w("queried_city", "measured_at")
    out = df.withColumns(W.rolling_columns("aqi", [(window, "x")], w, min_periods=min_periods)).collect()
    got = {(r.queried_city, r.measured_at): (r.aqi_roll_mean_x, r.aqi_roll_std_x, r.aqi_roll_min_x, r.aqi_roll_max_x)
           for r in out}
    mp = {None: 1, "full": window, "half": max(1, window // 2)}[min_periods]
    pdf = pd.DataFrame(rows, columns=["city", "ts", "aqi"]).astype({"aqi": float})
    for c, g in pdf.groupby("city"):
        r = g.set_index("ts")["aqi"].shift(1).rolling(window, min_periods=mp)
        exp = pd.DataFrame({"mean": r.mean(), "std": r.std(), "min": r.min(), "max": r.max()})
        for ts, e in exp.iterrows():
            mine = got[(c, ts.to_pydatetime())]
            for k, m in zip(["mean", "std", "min", "max"], mine):
                if np.isnan(e[k]):
                    assert m is None, (c, ts, k)
                else:
                    assert m == pytest.approx(e[k], abs=2e-6), (c, ts, k)


def test_fill_forward_back_median_matches_pandas(spark):
    rows = _series(11, null_share=0.4)
    rows = [(c, t, None) if t < T0 + dt.timedelta(hours=3) else (c, t, v) for c, t, v in rows]  # leading gap
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, aqi double")
    got = {(r.queried_city, r.measured_at): r.aqi for r in W.fill_forward_back_median(df, ["aqi"]).collect()}
    pdf = pd.DataFrame(rows, columns=["city", "ts", "aqi"]).astype({"aqi": float})
    for c, g in pdf.groupby("city"):
        s = g.set_index("ts")["aqi"]
        s = s.ffill().bfill().fillna(s.median())
        for ts, v in s.items():
            assert got[(c, ts.to_pydatetime())] == pytest.approx(v)


@pytest.mark.parametrize("seed", [0, 5])
def test_exact_quantiles_match_numpy_linear(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.round(rng.gamma(2.0, 40.0, 1000), 1)  # many ties
    keys = rng.choice(["x", "y", "z"], 1000)
    df = spark.createDataFrame([(str(k), float(v)) for k, v in zip(keys, vals)], "k string, v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    got = {r.k: r for r in profile.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k in "xyz":
        exp = np.percentile(vals[keys == k], [p * 100 for p in probs])
        assert [got[k][f"q{int(round(p * 100))}"] for p in probs] == pytest.approx(list(exp), abs=1e-6)


def test_spearman_matches_pandas_with_ties_and_nulls(spark):
    rng = np.random.default_rng(3)
    n = 400
    a = np.round(rng.normal(50, 10, n), 0)
    b = np.round(a * 0.5 + rng.normal(0, 5, n), 1)
    c = rng.integers(0, 5, n).astype(float)
    b[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"a": a, "b": b, "c": c})
    df = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in row) for row in pdf.itertuples(index=False)],
                               "a double, b double, c double")
    got = {(r.a, r.b): r.rho for r in stats.spearman(df, ["a", "b", "c"]).collect()}
    exp = pdf.corr(method="spearman")
    for x, y in [("a", "b"), ("a", "c"), ("b", "c")]:
        assert got[(x, y)] == pytest.approx(exp.loc[x, y], abs=1e-6)


def test_binned_mutual_info_matches_numpy(spark):
    rng = np.random.default_rng(9)
    n = 600
    t = np.round(rng.uniform(0, 200, n), 1)
    f1 = np.round(t * 0.5 + rng.normal(0, 10, n), 1)
    f2 = np.round(rng.uniform(0, 100, n), 1)
    pdf = pd.DataFrame({"t": t, "f1": f1, "f2": f2})
    df = spark.createDataFrame(pdf)
    got = {r.feature: r.mutual_info for r in stats.binned_mutual_info(df, ["f1", "f2"], "t").collect()}

    def bins(x):
        edges = np.percentile(x, [i * 10 for i in range(1, 10)])
        return (x[:, None] > edges[None, :]).sum(axis=1)

    by = bins(t)
    for f in ["f1", "f2"]:
        bx = bins(pdf[f].to_numpy())
        joint = pd.crosstab(bx, by).to_numpy().astype(float)
        p = joint / joint.sum()
        px, py = p.sum(axis=1, keepdims=True), p.sum(axis=0, keepdims=True)
        nz = p > 0
        mi = float((p[nz] * np.log(p[nz] / (px @ py)[nz])).sum())
        assert got[f] == pytest.approx(mi, abs=1e-6)
    assert got["f1"] > got["f2"]


def test_decompose_matches_classical_additive(spark):
    rng = np.random.default_rng(4)
    n = 70
    days = [T0 + dt.timedelta(days=i) for i in range(n)]
    x = np.round(100 + 10 * np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 2, n), 2)
    df = spark.createDataFrame([("a", d, float(v)) for d, v in zip(days, x)], "queried_city string, measured_at timestamp, aqi double")
    got = {r.measured_at: r for r in W.decompose(df).collect()}
    s = pd.Series(x, index=days)
    trend = s.rolling(7, center=True).mean()
    detr = s - trend
    phase = np.arange(n) % 7
    pm = detr.groupby(phase).mean()
    seasonal = (pm - pm.mean()).to_numpy()[phase]
    for i, d in enumerate(days):
        r = got[d]
        if np.isnan(trend.iloc[i]):
            assert r.trend is None
        else:
            assert r.trend == pytest.approx(trend.iloc[i], abs=1e-6)
            assert r.resid == pytest.approx(x[i] - trend.iloc[i] - seasonal[i], abs=1e-5)
        assert r.seasonal == pytest.approx(seasonal[i], abs=1e-5)
