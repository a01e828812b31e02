"""ML data queries: codes, splits, metrics, baselines, scaling, anomaly reports, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import ml
from smogline.operators import windows as W
from smogline.plans import q_features  # noqa: F401  (its oracle texts are reused below)
from smogline.plans.registry import ORACLE, query
from smogline.plans.sql_views import (
    READINGS, YEARLY, hourly_cte, r6, roll_sql, with_views, xavg,
)
from smogline.sources.testdata import readings, yearly_readings

TRAIN_END, VAL_END = "2024-01-20 00:00:00", "2024-01-25 00:00:00"
WIN = "WINDOW w AS (PARTITION BY queried_city ORDER BY measured_at)"


def _features(spark, sf_dir):
    return W.hourly_features(W.hourly(readings(spark, sf_dir)))


def _zscored(spark, sf_dir):
    h = W.hourly(readings(spark, sf_dir))
    f = h.withColumns(W.rolling_columns("aqi", [(168, "7d")], W._w("queried_city", "measured_at"), stats=("mean", "std")))
    return W.zscore_anomalies(f)


_Z_SQL = with_views(READINGS, hourly_cte(), f"""
f AS (SELECT *, {', '.join(roll_sql('aqi', 168, '7d', stats=('mean', 'std')))} FROM h {WIN}),
z0 AS (SELECT *, {r6("(aqi - aqi_roll_mean_7d) / NULLIF(aqi_roll_std_7d, 0.0)")} AS zscore_7d FROM f),
z AS (SELECT *, CASE WHEN abs(zscore_7d) > 3.0 THEN 1 ELSE 0 END AS is_anom_zscore FROM z0)""")


@query("city_code", with_views(READINGS, hourly_cte(), f"""
codes AS (SELECT queried_city, CAST(DENSE_RANK() OVER (ORDER BY queried_city) - 1 AS INTEGER) AS city_code
          FROM (SELECT DISTINCT queried_city FROM h WHERE measured_at < TIMESTAMP '{TRAIN_END}') t)""") + """
SELECT h.queried_city, coalesce(codes.city_code, -1) AS city_code, COUNT(*) AS n
FROM h LEFT JOIN codes USING (queried_city) GROUP BY 1, 2""")
def q_city_code(spark, sf_dir):
    h = W.hourly(readings(spark, sf_dir))
    table = ml.fit_codes(h.filter(F.col("measured_at") < F.lit(TRAIN_END).cast("timestamp")), "queried_city")
    return ml.apply_codes(h, table, "queried_city").groupBy("queried_city", "city_code").agg(
        F.count(F.lit(1)).alias("n"))


@query("time_split", with_views(READINGS, hourly_cte()) + f"""
SELECT CASE WHEN measured_at < TIMESTAMP '{TRAIN_END}' THEN 'train'
            WHEN measured_at < TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split,
  COUNT(*) AS n, MIN(measured_at) AS first_at, MAX(measured_at) AS last_at
FROM h GROUP BY 1""")
def q_time_split(spark, sf_dir):
    s = ml.time_split(W.hourly(readings(spark, sf_dir)), TRAIN_END, VAL_END)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("measured_at").alias("first_at"),
                                  F.max("measured_at").alias("last_at"))


_FEAT_SQL = with_views(READINGS, hourly_cte(), f"""
ft AS (SELECT *, {', '.join(e for n, lab in [(24, '24h'), (168, '7d')] for e in roll_sql('aqi', n, lab, stats=('mean',)))},
         LEAD(aqi, 24) OVER w AS aqi_target FROM h {WIN}),
te AS (SELECT * FROM ft WHERE measured_at >= TIMESTAMP '{VAL_END}')""")


def _metrics_sql(y: str, p: str) -> str:
    e = f"CASE WHEN {y} IS NOT NULL AND {p} IS NOT NULL THEN {y} - {p} END"
    return (f"{r6(f'AVG(abs({e}))')} AS mae, {r6(f'sqrt(AVG(({e}) * ({e})))')} AS rmse, "
            f"{r6(f'AVG(abs(({e}) / ({y} + 1e-6))) * 100.0')} AS mape, COUNT({e}) AS n")


_BASELINES = {"naive": "aqi", "rolling_mean_24h": "aqi_roll_mean_24h", "rolling_mean_7d": "aqi_roll_mean_7d"}


@query("baseline_metrics", _FEAT_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS name, {_metrics_sql('aqi_target', c)} FROM te" for n, c in _BASELINES.items()))
def q_baseline_metrics(spark, sf_dir):
    f = _features(spark, sf_dir)
    te = f.filter(F.col("measured_at") >= F.lit(VAL_END).cast("timestamp"))
    return ml.baseline_metrics(te, "aqi_target", _BASELINES)


@query("city_errors", _FEAT_SQL + f"""
SELECT queried_city, COUNT(*) AS n, {r6('AVG(abs(aqi_target - aqi))')} AS mae,
  {r6('sqrt(AVG((aqi_target - aqi) * (aqi_target - aqi)))')} AS rmse, {xavg('aqi_target')} AS mean_target
FROM te WHERE aqi_target IS NOT NULL AND aqi IS NOT NULL GROUP BY 1""")
def q_city_errors(spark, sf_dir):
    f = _features(spark, sf_dir)
    te = f.filter(F.col("measured_at") >= F.lit(VAL_END).cast("timestamp"))
    return ml.city_errors(te, "aqi_target", "aqi")


_SCALE_COLS = ["aqi", "pm25", "pm10", "temperature", "humidity", "pressure", "wind"]


@query("scale_features", with_views(READINGS, hourly_cte(), f"""
st AS (SELECT {', '.join(f"{xavg(c)} AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_COLS)}
       FROM h WHERE measured_at < TIMESTAMP '{TRAIN_END}')""") + f"""
SELECT queried_city, measured_at, {', '.join(f"{r6(f'({c} - m_{c}) / NULLIF(s_{c}, 0.0)')} AS {c}_z" for c in _SCALE_COLS)}
FROM h CROSS JOIN st""")
def q_scale_features(spark, sf_dir):
    h = W.hourly(readings(spark, sf_dir))
    stats = ml.fit_scaler(h.filter(F.col("measured_at") < F.lit(TRAIN_END).cast("timestamp")), _SCALE_COLS)
    return ml.apply_scaler(h.select("queried_city", "measured_at", *_SCALE_COLS), stats).drop(*_SCALE_COLS)


@query("anomaly_kpis", _Z_SQL + """
SELECT COUNT(*) AS "rows", CAST(SUM(is_anom_zscore) AS BIGINT) AS anomalies, AVG(is_anom_zscore) * 100.0 AS anomaly_rate_pct,
  CAST(COUNT_IF(is_anom_zscore = 1 AND aqi > 150.0) AS BIGINT) AS severe_anomalies FROM z""")
def q_anomaly_kpis(spark, sf_dir):
    return ml.flag_kpis(_zscored(spark, sf_dir), "is_anom_zscore")


@query("city_anomaly_rate", _Z_SQL + """
SELECT queried_city, COUNT(*) AS n, CAST(SUM(is_anom_zscore) AS BIGINT) AS n_anomalies, AVG(is_anom_zscore) * 100.0 AS rate_pct
FROM z GROUP BY 1""")
def q_city_anomaly_rate(spark, sf_dir):
    return ml.rate_by(_zscored(spark, sf_dir), "is_anom_zscore")


@query("detector_overlap", _Z_SQL + """,
o AS (SELECT COUNT_IF(is_anom_zscore = 1) AS n_a, COUNT_IF(aqi > 300.0) AS n_b,
             COUNT_IF(is_anom_zscore = 1 AND aqi > 300.0) AS n_both FROM z)
SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, CAST(n_both AS BIGINT) AS n_both,
  n_both / NULLIF(n_a, 0) AS share_of_a, n_both / NULLIF(n_b, 0) AS share_of_b FROM o""")
def q_detector_overlap(spark, sf_dir):
    """Agreement of the rolling z-score with the fixed hazard level."""
    z = _zscored(spark, sf_dir).withColumn("is_hazardous", (F.col("aqi") > 300).cast("int"))
    return ml.overlap(z, "is_anom_zscore", "is_hazardous")


@query("alerts", _Z_SQL + """
SELECT queried_city, measured_at, aqi, zscore_7d FROM z WHERE is_anom_zscore = 1 AND aqi > 150.0""")
def q_alerts(spark, sf_dir):
    return ml.alerts(_zscored(spark, sf_dir), "is_anom_zscore").select("queried_city", "measured_at", "aqi", "zscore_7d")


@query("top_anomalies", _Z_SQL + """
SELECT queried_city, measured_at, aqi, zscore_7d, abs(zscore_7d) AS score FROM z
ORDER BY score DESC NULLS LAST, queried_city, measured_at LIMIT 20""")
def q_top_anomalies(spark, sf_dir):
    z = _zscored(spark, sf_dir).select("queried_city", "measured_at", "aqi", "zscore_7d",
                                       F.abs("zscore_7d").alias("score"))
    return ml.top_k(z, "score", 20, ["queried_city", "measured_at"])


@query("top_anomalies_by_city", _Z_SQL + """
SELECT * FROM (SELECT queried_city, measured_at, aqi, abs(zscore_7d) AS score,
  CAST(ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY abs(zscore_7d) DESC NULLS LAST, queried_city, measured_at) AS INTEGER) AS rank
  FROM z) x WHERE rank <= 5""")
def q_top_anomalies_by_city(spark, sf_dir):
    z = _zscored(spark, sf_dir).select("queried_city", "measured_at", "aqi", F.abs("zscore_7d").alias("score"))
    return ml.top_k(z, "score", 5, ["queried_city", "measured_at"], per="queried_city")


def _yearly_daily_z(spark, sf_dir, k: float = 2.0):
    d = W.daily_means(yearly_readings(spark, sf_dir), measures=["aqi", "pm25"]).select("queried_city", "measured_at", "aqi")
    d = d.withColumns(W.rolling_columns("aqi", [(7, "7d")], W._w("queried_city", "measured_at"), stats=("mean", "std")))
    return W.zscore_anomalies(d, k=k)


_YZ_SQL = with_views(YEARLY, f"""
d AS (SELECT queried_city, date_trunc('day', measured_at) AS measured_at, {xavg('aqi')} AS aqi
      FROM yearly GROUP BY 1, 2 HAVING {xavg('aqi')} IS NOT NULL),
f AS (SELECT *, {', '.join(roll_sql('aqi', 7, '7d', stats=('mean', 'std')))} FROM d {WIN}),
z0 AS (SELECT *, {r6("(aqi - aqi_roll_mean_7d) / NULLIF(aqi_roll_std_7d, 0.0)")} AS zscore_7d FROM f),
z AS (SELECT *, CASE WHEN abs(zscore_7d) > 2.0 THEN 1 ELSE 0 END AS is_anom_zscore FROM z0)""")


@query("monthly_anomalies", _YZ_SQL + """,
c AS (SELECT queried_city, CAST(year(measured_at) AS INTEGER) AS year, CAST(month(measured_at) AS INTEGER) AS month,
        CAST(SUM(is_anom_zscore) AS BIGINT) AS n FROM z GROUP BY 1, 2, 3),
cal AS (SELECT DISTINCT queried_city, CAST(year(measured_at) AS INTEGER) AS year, CAST(unnest(range(1, 13)) AS INTEGER) AS month FROM z)
SELECT cal.queried_city, cal.year, cal.month, coalesce(c.n, 0) AS n_anomalies
FROM cal LEFT JOIN c USING (queried_city, year, month)""")
def q_monthly_anomalies(spark, sf_dir):
    return ml.monthly_counts(_yearly_daily_z(spark, sf_dir), "is_anom_zscore")


_SEASONS = {"winter": [11, 12, 1, 2], "summer": [6, 7, 8]}


@query("seasonal_anomaly_rate", _YZ_SQL + """
SELECT CASE WHEN month(measured_at) IN (11, 12, 1, 2) THEN 'winter' ELSE 'summer' END AS season,
  COUNT(*) AS n, AVG(is_anom_zscore) * 100.0 AS rate_pct
FROM z WHERE queried_city = 'ha-noi' AND month(measured_at) IN (11, 12, 1, 2, 6, 7, 8) GROUP BY 1""")
def q_seasonal_anomaly_rate(spark, sf_dir):
    return ml.seasonal_rate(_yearly_daily_z(spark, sf_dir), "is_anom_zscore", "ha-noi", _SEASONS)


# --- isolation forest (custom job; no SQL oracle: randomised trees) -------------------
_IF_FEATURES = ["aqi", "pm25", "pm10", "temperature", "humidity", "pressure", "wind"]


def _iforest_scored(spark, sf_dir, n_trees: int = 200):
    from smogline.operators.iforest import isolation_forest

    return isolation_forest(spark, _zscored(spark, sf_dir), ["queried_city", "measured_at"], _IF_FEATURES, n_trees=n_trees,
                            contamination=K.ANOMALY_CONTAMINATION)


@query("iforest_scores")
def q_iforest_scores(spark, sf_dir):
    return _iforest_scored(spark, sf_dir).select("queried_city", "measured_at", "aqi", "iforest_score",
                                                 "is_anom_iforest")


_IF_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _IF_FEATURES)


@query("iforest_invariants", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_outside FROM h WHERE {_IF_COMPLETE} GROUP BY 1""")
def q_iforest_invariants(spark, sf_dir):
    """Every complete hour is scored once, with a score in (0, 1]."""
    inside = (F.col("iforest_score") > 0) & (F.col("iforest_score") <= 1)
    return _iforest_scored(spark, sf_dir).groupBy("queried_city").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(inside, F.lit(False))).alias("n_outside"))


@query("anomaly_agreement")
def q_anomaly_agreement(spark, sf_dir):
    return ml.agreement(_iforest_scored(spark, sf_dir), "is_anom_zscore", "is_anom_iforest")


@query("iforest_rate")
def q_iforest_rate(spark, sf_dir):
    s = _iforest_scored(spark, sf_dir)
    return s.agg(F.avg("is_anom_iforest").alias("observed_rate"),
                 F.min(F.when(F.col("is_anom_iforest") == 1, F.col("iforest_score"))).alias("min_flagged_score"))


@query("contamination_sweep")
def q_contamination_sweep(spark, sf_dir):
    from smogline.operators.iforest import thresholds

    s = _iforest_scored(spark, sf_dir).persist()
    thr = thresholds(s, K.CONTAMINATION_SWEEP)
    z = F.coalesce(F.col("is_anom_zscore"), F.lit(0)) == 1
    aggs = []
    for r, t in zip(K.CONTAMINATION_SWEEP, thr):
        hit = F.col("iforest_score") > F.lit(t)
        aggs += [F.avg(hit.cast("int")).alias(f"f_{len(aggs)}"), F.count_if(hit & z).alias(f"o_{len(aggs)}"),
                 F.count_if(hit).alias(f"n_{len(aggs)}")]
    row = s.agg(*aggs)
    parts = []
    for i, r in enumerate(K.CONTAMINATION_SWEEP):
        j = 3 * i
        parts.append(F.struct(F.lit(r).alias("contamination"), (F.col(f"f_{j}") * 100.0).alias("pct_flagged"),
                              F.col(f"o_{j}").alias("overlap_with_zscore"),
                              (F.col(f"o_{j}") / F.greatest(F.col(f"n_{j}"), F.lit(1)) * 100.0).alias("overlap_pct")))
    return row.select(F.inline(F.array(*parts)))


# --- gradient-boosted forecast and contributions (MLlib; no SQL oracle) --------------
_DROP = ["measured_at", "queried_city", "aqi_target", "year", "month_part", "split", "is_val"]


def _gbt(spark, sf_dir):
    from smogline.operators import forecast

    f = _features(spark, sf_dir)
    codes = ml.fit_codes(f.filter(F.col("measured_at") < F.lit(TRAIN_END).cast("timestamp")), "queried_city")
    f = ml.apply_codes(f, codes, "queried_city")
    rows, feats = ml.training_rows(f, "aqi_target", _DROP)
    rows = ml.time_split(rows, TRAIN_END, VAL_END).withColumn("is_val", F.col("split") == "val").persist()
    model = forecast.train_gbt(rows.filter(F.col("split") != "test"), feats, max_iter=40, max_depth=4)
    return rows, feats, model


@query("gbt_forecast")
def q_gbt_forecast(spark, sf_dir):
    rows, feats, model = _gbt(spark, sf_dir)
    pred = model.transform(rows.filter(F.col("split") == "test"))
    return pred.select("queried_city", "measured_at", "aqi_target", F.col("prediction").alias("predicted_aqi"))


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    rows, feats, model = _gbt(spark, sf_dir)
    te = model.transform(rows.filter(F.col("split") == "test"))
    base = ml.baseline_metrics(te, "aqi_target", {**_BASELINES, "gbt": "prediction"})
    return ml.approval(base, K.MODEL_APPROVAL_MAE).orderBy("mae", "name")  # presentation order


@query("contributions")
def q_contributions(spark, sf_dir):
    from smogline.operators import forecast

    rows, feats, model = _gbt(spark, sf_dir)
    te = rows.filter(F.col("split") == "test")
    c = forecast.contributions(spark, te, model, feats, ["queried_city", "measured_at"])
    return forecast.importance(c, ["queried_city"], top=5)


@query("contribution_invariants", f"""SELECT queried_city, COUNT(*) AS n, CAST(0 AS BIGINT) AS n_off
FROM ({ORACLE['feature_table']}) f WHERE measured_at >= TIMESTAMP '{VAL_END}' AND COLUMNS(*) IS NOT NULL GROUP BY 1""")
def q_contribution_invariants(spark, sf_dir):
    """Every complete test row is explained once: base and contributions add up to its prediction."""
    from smogline.operators import forecast

    rows, feats, model = _gbt(spark, sf_dir)
    te, keys = rows.filter(F.col("split") == "test"), ["queried_city", "measured_at"]
    sums = forecast.contributions(spark, te, model, feats, keys).groupBy(*keys).agg(F.sum("contribution").alias("total"))
    both = model.transform(te).select(*keys, "prediction").join(sums, keys, "left")
    off = F.coalesce(F.abs(F.col("prediction") - F.col("total")) > 1e-6, F.lit(True))
    return both.groupBy("queried_city").agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("n_off"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    from smogline.operators import forecast

    rows, feats, model = _gbt(spark, sf_dir)
    c = forecast.contributions(spark, rows.filter(F.col("split") == "test"), model, feats,
                               ["queried_city", "measured_at"])
    return forecast.importance(c, top=10)


@query("contribution_waterfall")
def q_contribution_waterfall(spark, sf_dir):
    from smogline.operators import forecast

    rows, feats, model = _gbt(spark, sf_dir)
    te = ml.require_columns(rows.filter(F.col("split") == "test"), feats)
    last = te.filter(F.col("queried_city") == "ha-noi").agg(F.max("measured_at")).first()[0]
    c = forecast.contributions(spark, te.filter((F.col("queried_city") == "ha-noi") & (F.col("measured_at") == last)),
                               model, feats, ["queried_city", "measured_at"])
    return forecast.waterfall(c, F.lit(True), top=10)


@query("forecast_table")
def q_forecast_table(spark, sf_dir):
    rows, feats, model = _gbt(spark, sf_dir)
    pred = model.transform(ml.require_columns(rows.filter(F.col("split") == "test"), feats))
    return pred.select("queried_city", "measured_at", F.col("prediction").alias("predicted_aqi"),
                       F.lit("run-0001").alias("run_id"), F.lit("gbt-aqi-24h").alias("model_id"),
                       F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("made_at"))


DAILY_VAL, DAILY_SPLIT = "2024-01-21 00:00:00", "2024-01-24 00:00:00"
_DAILY_BASELINES = {"naive": "aqi", "rolling_mean_7d": "aqi_roll_mean_7d"}


def _daily_rows(spark, sf_dir):
    return W.daily_feature_columns(W.filled_daily(readings(spark, sf_dir)))


@query("daily_baselines", f"WITH te AS (SELECT * FROM ({ORACLE['daily_features']}) d WHERE measured_at >= TIMESTAMP '{DAILY_SPLIT}')\n"
       + "\nUNION ALL\n".join(f"SELECT '{n}' AS name, {_metrics_sql('aqi_target', c)} FROM te" for n, c in _DAILY_BASELINES.items()))
def q_daily_baselines(spark, sf_dir):
    """Next-day baselines on the days after the split date."""
    te = _daily_rows(spark, sf_dir).filter(F.col("measured_at") >= F.lit(DAILY_SPLIT).cast("timestamp"))
    return ml.baseline_metrics(te, "aqi_target", _DAILY_BASELINES)


@query("daily_forecast")
def q_daily_forecast(spark, sf_dir):
    """Next-day forecast: daily features without gaps, split by date, boosted trees, errors beside the baselines."""
    from smogline.operators import forecast

    rows, feats = ml.training_rows(_daily_rows(spark, sf_dir), "aqi_target", _DROP)
    rows = ml.time_split(rows, DAILY_VAL, DAILY_SPLIT).withColumn("is_val", F.col("split") == "val")
    model = forecast.train_gbt(rows.filter("split <> 'test'"), feats, max_iter=20, max_depth=3)
    return ml.baseline_metrics(model.transform(rows.filter("split = 'test'")), "aqi_target", {**_DAILY_BASELINES, "gbt": "prediction"})


@query("sample_features", f"""SELECT * FROM ({ORACLE['feature_table']}) f
ORDER BY md5(queried_city || '|' || CAST(measured_at AS VARCHAR) || '|42'), queried_city, measured_at LIMIT 500""")
def q_sample_features(spark, sf_dir):
    return ml.seeded_sample(_features(spark, sf_dir), 500, ["queried_city", "measured_at"], seed=42)


_DRIFT_SQL = _Z_SQL + f""",
s AS (SELECT *, CASE WHEN measured_at < TIMESTAMP '{TRAIN_END}' THEN 'train'
                     WHEN measured_at < TIMESTAMP '{VAL_END}' THEN 'val' ELSE 'test' END AS split FROM z),
w AS (SELECT {', '.join(f"AVG(CASE WHEN split = 'train' THEN {e} END) AS b_{n}, AVG(CASE WHEN split = 'test' THEN {e} END) AS c_{n}"
                        for n, e in [('aqi_mean', 'aqi'), ('pm25_mean', 'pm25'), ('humidity_mean', 'humidity'),
                                     ('anomaly_rate', 'CAST(is_anom_zscore AS DOUBLE)')])} FROM s),
l AS ({' UNION ALL '.join(f"SELECT '{n}' AS metric, {r6(f'b_{n}')} AS baseline, {r6(f'c_{n}')} AS current FROM w"
                          for n in ['aqi_mean', 'pm25_mean', 'humidity_mean', 'anomaly_rate'])})
SELECT *, {r6('(current - baseline) / NULLIF(baseline, 0) * 100.0')} AS change_pct,
  abs({r6('(current - baseline) / NULLIF(baseline, 0) * 100.0')}) > 50.0 AS drift FROM l"""


@query("drift_watch", _DRIFT_SQL)
def q_drift_watch(spark, sf_dir):
    z = ml.time_split(_zscored(spark, sf_dir), TRAIN_END, VAL_END)
    return ml.drift(z, "split", "train", "test", {
        "aqi_mean": F.col("aqi"), "pm25_mean": F.col("pm25"), "humidity_mean": F.col("humidity"),
        "anomaly_rate": F.col("is_anom_zscore").cast("double")}, K.DRIFT_CHANGE_PCT)


@query("iforest_alerts")
def q_iforest_alerts(spark, sf_dir):
    """Isolation-forest flags above the AQI alert level, keys kept (run summary via anomaly KPIs)."""
    s = _iforest_scored(spark, sf_dir)
    return ml.alerts(s, "is_anom_iforest").select("queried_city", "measured_at", "aqi", "iforest_score")


@query("seasonal_iforest_rate")
def q_seasonal_iforest_rate(spark, sf_dir):
    """Winter vs summer isolation-forest anomaly rate of one city over the multi-year daily series."""
    from smogline.operators.iforest import isolation_forest

    feats = ["aqi", "pm25", "pm10", "humidity", "temperature"]
    d = W.daily_means(yearly_readings(spark, sf_dir), measures=feats)
    s = isolation_forest(spark, d, ["queried_city", "measured_at"], feats, contamination=K.ANOMALY_CONTAMINATION)
    return ml.seasonal_rate(s, "is_anom_iforest", "ha-noi", _SEASONS)
