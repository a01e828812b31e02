"""Operator unit tests on tiny literal frames (the reference's test intents, in Spark)."""

import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions import columns as C
from smogline.operators import clean, dedup, gold, ml, quality, windows as W


def _ts(h, d=1):
    return dt.datetime(2024, 1, d) + dt.timedelta(hours=h)


def test_aqi_level_ladder_and_null(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 50.0, 50.5, 100.0, 150.0, 200.0, 300.0, 300.1, None]], "v double")
    got = [r[0] for r in df.select(C.aqi_level("v")).collect()]
    assert got == ["Good", "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
                   "Very Unhealthy", "Hazardous", None]


def test_parse_number_tokens_and_thousands(spark):
    df = spark.createDataFrame([(x,) for x in ["-", "", "#NAME?", "N/A", "1,013", " 42.5 ", "abc", None]], "s string")
    got = [r[0] for r in df.select(C.parse_number("s")).collect()]
    assert got == [None, None, None, None, 1013.0, 42.5, None, None]


def test_clean_numeric_struct_of_choices(spark):
    df = spark.createDataFrame([Row(v=Row(double=None, string="12")), Row(v=Row(double=3.5, string=None)),
                                Row(v=Row(double=None, string="-"))], "v struct<double:double,string:string>")
    got = [r[0] for r in df.select(C.clean_numeric(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [12.0, 3.5, None]


def test_keyword_category_first_match_and_case(spark):
    df = spark.createDataFrame([("Hanoi, Ho Chi Minh",), ("ha noi station",), ("Cao Bằng",), (None,), ("Paris",)], "s string")
    etl = [r[0] for r in df.select(C.keyword_category("s")).collect()]
    assert etl == ["ho-chi-minh-city", None, "cao-bang", None, None]
    ana = [r[0] for r in df.select(C.keyword_category("s", K.CITY_KEYWORDS_ANALYSIS, True, "other", "unknown")).collect()]
    assert ana == ["ha-noi", "ha-noi", "cao-bang", "unknown", "other"]


def test_city_from_url(spark):
    df = spark.createDataFrame([("https://x/city/vietnam/hanoi/a/",), ("https://x/city/vietnam/hue/a/",),
                                ("https://x/feed/1",), (None,)], "u string")
    assert [r[0] for r in df.select(C.city_from_url("u")).collect()] == ["ha-noi", "hue", "unknown", "unknown"]


def test_timestamp_with_offset(spark):
    df = spark.createDataFrame([("2024-01-01 07:00:00", "+07:00"), ("bad", "+07:00")], "s string, tz string")
    got = [r[0] for r in df.select(C.timestamp_with_offset("s", "tz")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0) and got[1] is None


def test_cyclical_bounded_and_periodic(spark):
    df = spark.range(48).select((F.col("id") % 24).alias("h"))
    s, c = C.cyclical("h", 24)
    rows = df.select(s.alias("s"), c.alias("c")).collect()
    assert all(-1 <= r.s <= 1 and -1 <= r.c <= 1 for r in rows)
    assert rows[0] == rows[24]


def test_mode_ties_alphabetical_null_last(spark):
    df = spark.createDataFrame([("a", "pm25"), ("a", "pm10"), ("a", None), ("b", None), ("b", None), ("b", "o3"),
                                ("c", None), ("c", "o3")], "k string, p string")
    got = {r.k: r.p for r in gold.grouped_mode(df, ["k"], "p").collect()}
    assert got == {"a": "pm10", "b": None, "c": "o3"}


def test_latest_per_key_full_tie_break(spark):
    df = spark.createDataFrame([(1, "t1", 5.0), (1, "t2", 6.0), (1, "t2", 7.0), (2, "t1", 1.0)], "k int, at string, v double")
    got = {r.k: (r.at, r.v) for r in dedup.latest_per_key(df, ["k"], ["at"]).collect()}
    assert got == {1: ("t2", 7.0), 2: ("t1", 1.0)}


def test_upsert_keeps_existing_and_appends_new(spark):
    ex = spark.createDataFrame([(1, "old")], "k int, name string")
    new = spark.createDataFrame([(1, "new"), (2, "two"), (2, "two")], "k int, name string")
    got = sorted(tuple(r) for r in dedup.upsert_new(ex, new, ["k"]).collect())
    assert got == [(1, "old"), (2, "two")]
    assert sorted(tuple(r) for r in dedup.upsert_new(None, new, ["k"]).collect()) == [(1, "new"), (2, "two")]


def test_lag_per_city_null_first_and_target(spark):
    rows = [("a", _ts(h), float(h)) for h in range(30)] + [("b", _ts(h), 100.0 + h) for h in range(30)]
    df = spark.createDataFrame(rows, "queried_city string, measured_at timestamp, aqi double")
    w = W._w("queried_city", "measured_at")
    out = df.withColumns({"lag1": F.lag("aqi", 1).over(w), "target": F.lead("aqi", 24).over(w)}).orderBy(
        "queried_city", "measured_at").collect()
    a = [r for r in out if r.queried_city == "a"]
    assert a[0].lag1 is None and a[1].lag1 == 0.0
    assert a[0].target == 24.0 and all(r.target is None for r in a[-24:])


def test_rolling_excludes_current_and_min_periods(spark):
    df = spark.createDataFrame([("a", _ts(h), float(v)) for h, v in enumerate([1, 2, 3, 4, 100])],
                               "queried_city string, measured_at timestamp, aqi double")
    w = W._w("queried_city", "measured_at")
    out = df.withColumns(W.rolling_columns("aqi", [(3, "3h")], w, min_periods="full")).orderBy("measured_at").collect()
    assert [r.aqi_roll_mean_3h for r in out] == [None, None, None, 2.0, 3.0]
    assert out[4].aqi_roll_max_3h == 4.0 and out[4].aqi_roll_min_3h == 2.0
    assert all(r.aqi_roll_min_3h is None or r.aqi_roll_min_3h <= r.aqi_roll_mean_3h <= r.aqi_roll_max_3h for r in out)


def test_interpolate_limit_and_trailing(spark):
    vals = [1.0, None, None, 4.0] + [None] * 8 + [20.0, None, None]
    df = spark.createDataFrame([("a", _ts(h), v) for h, v in enumerate(vals)],
                               "queried_city string, measured_at timestamp, aqi double")
    out = [r.aqi for r in W.interpolate(df, ["aqi"], limit=6).orderBy("measured_at").collect()]
    assert out[:4] == [1.0, 2.0, 3.0, 4.0]
    assert out[4:10] == pytest.approx([5.777778, 7.555556, 9.333333, 11.111111, 12.888889, 14.666667], abs=1e-6)
    assert out[10] is None and out[11] is None and out[12] == 20.0
    assert out[13:] == [20.0, 20.0]


def test_regularize_fills_missing_hours(spark):
    df = spark.createDataFrame([("a", _ts(0), 1.0), ("a", _ts(3), 2.0)], "queried_city string, measured_at timestamp, aqi double")
    out = W.regularize(df).orderBy("measured_at").collect()
    assert [r.aqi for r in out] == [1.0, None, None, 2.0]


def test_zscore_zero_std_is_null_and_unflagged(spark):
    df = spark.createDataFrame([(10.0, 10.0, 0.0), (20.0, 10.0, 2.0), (11.0, 10.0, 1.0)],
                               "aqi double, aqi_roll_mean_7d double, aqi_roll_std_7d double")
    out = W.zscore_anomalies(df).collect()
    assert out[0].zscore_7d is None and out[0].is_anom_zscore == 0
    assert out[1].is_anom_zscore == 1 and out[2].is_anom_zscore == 0


def _fact(spark, rows):
    return spark.createDataFrame(rows, "aqi double, measured_at timestamp, dominant_pollutant string, "
                                       "queried_city string, source string, ingested_at string")


def test_dq_checks_pass_and_fail(spark):
    good = [(50.0, _ts(h % 24, 1 + h // 24), "pm25", c, "api", "2024-02-02T00:00:00")
            for h, c in enumerate(K.EXPECTED_CITIES * 4)]
    dim = spark.createDataFrame([(1, c) for c in K.EXPECTED_CITIES], "waqi_idx int, queried_city string")
    res = {(r.check, r.column): r.passed for r in quality.run_checks(_fact(spark, good), dim, "2024-02-03").collect()}
    assert len(res) == 11 and all(res.values())
    bad = good[:3] + [(600.0, None, None, "ha-noi", "csv", "2023-01-01T00:00:00")]
    res = {(r.check, r.column): r.passed for r in quality.run_checks(_fact(spark, bad), dim.limit(0), "2024-02-03").collect()}
    assert not res[("row_count", None)] and not res[("aqi_range", "aqi")]
    assert not res[("city_coverage", "queried_city")] and not res[("source_validity", "source")]
    assert not res[("null_pct", "measured_at")] and not res[("dim_station_row_count", None)]
    assert res[("freshness", "ingested_at")]
    assert not quality.gate(quality.run_checks(_fact(spark, bad), dim, "2024-02-03"))


def test_codes_unseen_minus_one(spark):
    train = spark.createDataFrame([("ha-noi",), ("ho-chi-minh-city",)], "queried_city string")
    table = ml.fit_codes(train, "queried_city")
    df = spark.createDataFrame([("ha-noi",), ("ho-chi-minh-city",), ("paris",)], "queried_city string")
    got = {r.queried_city: r.city_code for r in ml.apply_codes(df, table, "queried_city").collect()}
    assert got == {"ha-noi": 0, "ho-chi-minh-city": 1, "paris": -1}


def test_time_split_empty_raises(spark):
    df = spark.createDataFrame([(_ts(1),)], "measured_at timestamp")
    s = ml.time_split(df, "2024-01-05", "2024-01-06")
    with pytest.raises(RuntimeError):
        ml.check_splits(s.groupBy("split").count())


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    stats = ml.fit_scaler(df, ["x"])
    assert stats["x"] == (2.0, 1.0)
    assert [r.x_z for r in ml.apply_scaler(df, stats).collect()] == [-1.0, 1.0]


def test_metrics_mape_epsilon(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 25.0), (None, 1.0)], "y double, p double")
    r = ml.evaluate(df, "y", "p").first()
    assert r.n == 2 and r.mae == 3.5 and math.isclose(r.rmse, math.sqrt((4 + 25) / 2), abs_tol=1e-6)
    assert math.isclose(r.mape, (0.2 + 0.25) / 2 * 100, abs_tol=1e-3)


def test_drop_stale_uses_given_now(spark):
    df = spark.createDataFrame([(_ts(0, 1),), (_ts(0, 3),)], "measured_at timestamp")
    assert clean.drop_stale(df, "2024-01-04 00:00:00", 48).count() == 1


def test_require_columns_raises(spark):
    df = spark.createDataFrame([(1.0,)], "aqi double")
    with pytest.raises(ValueError):
        ml.require_columns(df, ["aqi", "aqi_lag_1h"])
    assert ml.require_columns(df, ["aqi"]) is df


def test_partition_text_zero_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 1),)], "ts timestamp")
    r = df.select(C.year_text("ts").alias("y"), C.month_text("ts").alias("m")).first()
    assert (r.y, r.m) == ("2024", "03")


def test_flatten_skips_non_ok_and_reads_text_aqi(spark):
    from smogline import schemas

    doc = {"status": "error", "data": {"aqi": "42", "idx": 1, "dominentpol": "pm25", "city": None,
                                       "time": {"iso": "2024-01-01T00:00:00Z"}, "iaqi": None},
           "queried_city": "ha-noi", "year": "2024", "month": "01", "day": "01"}
    ok = dict(doc, status="ok")
    dash = dict(ok, data=dict(ok["data"], aqi="-", idx=2))
    df = spark.createDataFrame([doc, ok, dash], schemas.API_DOCUMENT_WITH_PATH)
    got = {r.waqi_idx: r.aqi for r in clean.flatten_reading(df, ingested_at="x").collect()}
    assert got == {1: 42.0, 2: None}


def test_top_k_per_group_with_hot_group_matches_plain_rank(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i, float((i * 7919) % 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id int, score double")
    got = sorted((r.g, r.id, r.rank) for r in ml.top_k(df, "score", 5, ["id"], per="g", salt_buckets=8).collect())
    from pyspark.sql import Window

    w = Window.partitionBy("g").orderBy(F.col("score").desc(), "id")
    want = sorted((r.g, r.id, r.rank) for r in df.withColumn("rank", F.row_number().over(w))
                  .filter("rank <= 5").collect())
    assert got == want


def test_decomposition_keeps_its_phase_over_missing_days(spark):
    """A series of pure weekday means: days that are missing (one, a run within the limit and a longer one) shift nothing."""
    import datetime as dt

    from smogline.operators import windows as W

    start, weekday = dt.datetime(2024, 1, 1), [50.0, 52.0, 54.0, 60.0, 54.0, 52.0, 35.0]
    days = [d for d in range(140) if d not in (9, 30, 31, 32, *range(60, 69))]
    df = spark.createDataFrame([("a", start + dt.timedelta(days=d), weekday[d % 7]) for d in days],
                               "queried_city string, measured_at timestamp, aqi double")
    got = {(r["measured_at"] - start).days: r for r in W.decompose(df).collect()}
    assert set(got) == set(range(140)) - set(range(65, 69))  # five steps of the long run are filled
    mean = sum(weekday) / 7
    for d in range(100, 137):  # far from any gap
        assert abs(got[d]["trend"] - mean) < 1e-6
    phases = {d % 7: got[d]["seasonal"] for d in got}
    assert all(got[d]["seasonal"] == phases[d % 7] for d in got)
    assert max(phases, key=phases.get) == 3 and min(phases, key=phases.get) == 6


def test_pivot_counts_further_values_as_other(spark):
    from smogline.operators import profile

    df = spark.createDataFrame([(0, "a", 1.0), (0, "x", 3.0), (0, None, 5.0), (1, "b", 2.0)], "r int, c string, aqi double")
    rows = {r["r"]: r for r in profile.pivot_mean(df, "r", "c", ["a", "b"], other="other").collect()}
    assert rows[0]["a"] == 1.0 and rows[0]["other"] == 4.0 and rows[1]["b"] == 2.0 and rows[1]["other"] is None
