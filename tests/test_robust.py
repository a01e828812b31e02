"""Robust decomposition: weekday effects and trend of a series with outliers and missing days."""

import datetime as dt

import numpy as np

from smogline.operators import robust as R

START = dt.datetime(2024, 1, 1)


def test_outliers_and_missing_days_change_neither_phase_nor_trend(spark):
    weekday = np.array([4.0, 2, 0, 1, -1, -2, -4])
    days = np.arange(150)
    clean = 50 + 0.2 * days + weekday[days % 7]
    value = clean + np.random.default_rng(0).normal(scale=0.05, size=150)
    value[[20, 71, 72, 120]] += [300, 250, -200, 400]
    there = [d for d in days.tolist() if d not in (9, 40, 41, 42, *range(95, 104))]
    rows = [("a", START + dt.timedelta(days=d), float(value[d])) for d in there] + [(None, START, 3.0)]
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, aqi double").repartition(3)
    got = R.robust_decompose(df).collect()
    own = {(r["measured_at"] - START).days: r for r in got if r["queried_city"]}
    assert set(own) == set(range(150)) - set(range(100, 104))  # five steps of the long run are filled
    for d in (20, 71, 72, 120):
        assert own[d]["weight"] == 0.0 and abs(own[d]["resid"]) > 150
    plain = [d for d in there if d not in (20, 71, 72, 120)]
    off = lambda rows: np.abs([rows[d]["seasonal"] - weekday[d % 7] for d in plain]).max()
    once = {(r["measured_at"] - START).days: r for r in R.robust_decompose(df, rounds=1).collect() if r["queried_city"]}
    assert off(own) < 0.6 and off(own) < off(once) / 4
    assert np.median([abs(own[d]["trend"] - (50 + 0.2 * d)) for d in plain]) < 0.3
    alone = [r for r in got if r["queried_city"] is None]
    assert len(alone) == 1 and alone[0]["trend"] == 3.0 and alone[0]["resid"] == 0.0


def test_local_line_is_weighted_least_squares(spark):
    rng = np.random.default_rng(3)
    y, w = rng.normal(size=40), rng.random(40)
    w[[3, 4, 30]] = 0
    rows = [("k", START + dt.timedelta(days=i), float(a), float(b)) for i, (a, b) in enumerate(zip(y, w, strict=True))]
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, v double, w double")
    got = [r["line"] for r in R.local_line(df, "v", "w", "line", reach=5).orderBy("measured_at").collect()]
    for i in range(40):
        j = np.arange(max(0, i - 5), min(40, i + 6))
        weight = np.array([R.tricube(x - i, 5) for x in j]) * w[j]
        want = np.polyval(np.polyfit(j - i, y[j], 1, w=np.sqrt(weight)), 0)
        assert abs(got[i] - want) < 1e-5


def test_empty_series(spark):
    df = spark.createDataFrame([], "queried_city string, measured_at timestamp, aqi double")
    assert R.robust_decompose(df).collect() == []
