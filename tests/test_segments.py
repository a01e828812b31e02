"""Windows, fills, ranks and quantiles over one hot key, against the whole-series versions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import profile
from smogline.operators import segments as S
from smogline.operators import windows as W
from tests.oracle import canon, norm

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hourly(spark):
    """One city with 90 % of 4,000 rows, two small ones and rows without a city; gaps in time, runs of nulls."""
    rng = np.random.default_rng(7)
    rows = []
    for city, n in (("hot", 3600), ("small", 300), ("tiny", 3), (None, 97)):
        at = np.cumsum(rng.choice([1, 1, 1, 1, 2, 9], n))
        known = {c: rng.random(n) > 0.3 for c in ("pm25", "pm10")}
        known["pm10"][: n // 2] &= rng.random(n // 2) > 0.97  # long runs of nulls
        for i, h in enumerate(at.tolist()):
            aqi = 80 + 20 * float(np.sin(h / 24)) + float(rng.normal())
            rows.append((city, START + dt.timedelta(hours=h), aqi, aqi * 0.7 if known["pm25"][i] else None,
                         aqi * 0.9 if known["pm10"][i] else None, 30.0, None, 1000.0, 1.0))
    names = ["queried_city", "measured_at", *K.HOURLY_MEASURES]
    return spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))],
                                 ", ".join([f"{names[0]} string", f"{names[1]} timestamp", *(f"{c} double" for c in names[2:])]))


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    rows = [canon([tuple(norm(r[c]) for c in want.columns) for r in df.collect()]) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def test_positions_number_every_series(spark, hourly):
    for n in (1, 13):
        rows = S.positions(hourly, partitions=n).orderBy("queried_city", "measured_at").collect()
        of = {}
        for r in rows:
            assert r["_pos"] == of.get(r["queried_city"], 0)
            of[r["queried_city"]] = r["_pos"] + 1
    assert of == {"hot": 3600, "small": 300, "tiny": 3, None: 97}


def test_features_by_segments_equal_whole_series(hourly):
    same(S.hourly_features(hourly, rows=200), W.hourly_features(hourly))
    same(S.sequences(hourly, ["aqi", "pm25"], length=5, horizon=3, rows=7), W.sequences(hourly, ["aqi", "pm25"], length=5, horizon=3))
    stats = W.rolling_columns("aqi", [(168, "7d")], W._w(W.KEY, W.TS), ("mean", "std"))
    same(S.zscore_anomalies(hourly, rows=170), W.zscore_anomalies(hourly.withColumns(stats)))
    with pytest.raises(ValueError):
        S.by_segments(hourly, lambda d, k: d, 24, 0, rows=24)


@pytest.mark.parametrize("rows", [3, 57])  # 57: 64 segments of the hot city
def test_fills_by_segments_equal_whole_series(hourly, rows):
    same(S.regularize(hourly, rows=rows), W.regularize(hourly))
    grid = W.regularize(hourly)
    same(S.interpolate(grid, ["aqi", "pm25", "pm10", "temperature"], rows=rows), W.interpolate(grid, ["aqi", "pm25", "pm10", "temperature"]))
    same(S.fill(hourly, ["pm25", "pm10", "humidity"], rows=rows), W.fill_forward_back_median(hourly, ["pm25", "pm10", "humidity"]))


def test_one_city_spreads_over_tasks(spark, hourly):
    """The rows of the range partitions, and of the windows' tasks when the hot city holds 90 % of the rows."""
    parts = S.positions(hourly, partitions=16).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(parts) >= 8
    ranged = hourly.repartitionByRange(16, "queried_city", "measured_at").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert ranged.max() <= 2 * ranged.median()
    seen = []

    def job(d, keys):
        seen.append(d.groupBy(*keys).count().toPandas()["count"])
        return d

    S.by_segments(hourly, job, 24, 6, rows=120)
    assert seen[0].max() <= 2 * seen[0].median() and len(seen[0]) >= 30


def test_ranks_of_near_unique_values_spread(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate((rng.normal(size=5000), np.repeat(0.25, 700), rng.integers(0, 5, 300)))
    keys = np.where(rng.random(6000) < 0.9, "hot", "cold")
    df = spark.createDataFrame([(str(k), float(v)) for k, v in zip(keys, values, strict=True)] + [(None, 1.0), (None, 2.0)], "k string, v double")
    vc = profile.value_counts(df, ["k"], "v")
    for n in (1, 16):
        got = {(r["k"], r["v"]): (r["_before"], r["_c"], r["_n"]) for r in profile.running_count(vc, ["k"], "v", n).collect()}
        for k in ("hot", "cold"):
            mine = np.sort(values[keys == k])
            assert {v: x[0] for (q, v), x in got.items() if q == k} == {v: int(np.searchsorted(mine, v)) for v in np.unique(mine)}
            assert {x[2] for (q, _), x in got.items() if q == k} == {len(mine)}
        assert got[(None, 2.0)] == (1, 1, 2)
    pieces = vc.withColumn("_key", F.struct("k")).repartitionByRange(16, "_key", "v").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert pieces.max() <= 2 * pieces.median()


@pytest.mark.parametrize("accuracy", [100, 1000, 20_000])
def test_quantiles_by_selection_are_exact(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    series = {"near_unique": rng.normal(size=9000), "ties": np.round(rng.gamma(2, 3, 5000)), "one": np.array([3.5]), "two": np.array([1.0, 2.0]),
              "few": rng.normal(size=199), "same": np.repeat(7.0, 1500), None: rng.normal(size=210)}
    rows = [(k, float(v)) for k, x in series.items() for v in x] + [("none", None), ("ties", None)]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "k string, v double").repartition(7)
    probs = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    got = {r["k"]: r for r in profile.exact_quantiles(df, ["k"], "v", probs, digits=None, accuracy=accuracy).collect()}
    assert set(got) == set(series)
    for k, x in series.items():
        assert [got[k][f"q{int(round(p * 100))}"] for p in probs] == pytest.approx(np.quantile(x, probs).tolist(), abs=1e-12)
    every = np.concatenate(list(series.values()))
    row = profile.exact_quantiles(df, [], "v", probs, accuracy=accuracy).collect()
    assert list(row[0]) == pytest.approx(np.quantile(every, probs).tolist(), abs=1e-6)
    assert [list(r) for r in profile.exact_quantiles(df.limit(0), [], "v", [0.5]).collect()] == [[None]]
    assert profile.exact_quantiles(df.limit(0), ["k"], "v", [0.5]).collect() == []


def test_few_values_are_ordered(spark):
    """The second pass keeps 4 of ``accuracy`` parts of the rows for each probability."""
    df = spark.range(200_000).select(F.lit("a").alias("k"), F.rand(3).alias("v"))
    at = profile.quantile_intervals(df, ["k"], "v", [0.25, 0.5], accuracy=1000).first()["_at"]
    for a in at:
        assert 0 < df.filter(F.col("v").between(a["low"], a["high"])).count() <= 6 * 200
