"""Analysis queries: profiles, quantiles, pivots, shares, KPIs (notebook/dashboard tables)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions.columns import aqi_level, exact_avg, rounded_avg, weekday_mon0
from smogline.operators import gold, profile
from smogline.operators.clean import in_box
from smogline.plans.q_gold import _DAILY_SQL, daily_ctes, monthly_ctes
from smogline.plans.registry import query
from smogline.plans.sql_views import READINGS, STATIONS, YEARLY, level, r6, ravg, with_views, xavg
from smogline.sources.testdata import readings, stations, yearly_readings

_R_COLS = ["waqi_idx", "measured_at", "queried_city", "aqi", "dominant_pollutant", "pm25", "pm10", "humidity",
           "temperature", "pressure", "wind", "source"]


@query("null_profile", with_views(READINGS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 AS missing_pct FROM readings"
    for c in _R_COLS))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(readings(spark, sf_dir).select(*_R_COLS))


def _q(x, p):
    return r6(f"quantile_cont({x}, {p})")


_DESC_COLS = ["aqi", "pm25", "pm10", "humidity"]


@query("describe", with_views(READINGS) + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", COUNT({c}) AS count, {xavg(c)} AS mean, {r6(f'stddev_samp({c})')} AS std,
  CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, {_q(c, 0.25)} AS p25, {_q(c, 0.5)} AS p50,
  {_q(c, 0.75)} AS p75 FROM readings""" for c in _DESC_COLS))
def q_describe(spark, sf_dir):
    return profile.describe(readings(spark, sf_dir), _DESC_COLS)


@query("city_stats", with_views(READINGS) + f"""
SELECT queried_city, COUNT(aqi) AS count, {xavg('aqi')} AS mean, {r6('stddev_samp(aqi)')} AS std,
  MIN(aqi) AS min, MAX(aqi) AS max, AVG(CASE WHEN aqi > 100 THEN 1 ELSE 0 END) * 100.0 AS pct_above_100,
  {_q('aqi', 0.5)} AS median
FROM readings GROUP BY 1""")
def q_city_stats(spark, sf_dir):
    return profile.city_stats(readings(spark, sf_dir))


@query("box_stats", with_views(READINGS, f"""
q AS (SELECT queried_city, {_q('aqi', 0.25)} AS q1, {_q('aqi', 0.5)} AS median, {_q('aqi', 0.75)} AS q3
      FROM readings GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)""") + """
SELECT f.*, MIN(CASE WHEN aqi BETWEEN lower_fence AND upper_fence THEN aqi END) AS whisker_low,
  MAX(CASE WHEN aqi BETWEEN lower_fence AND upper_fence THEN aqi END) AS whisker_high,
  CAST(COUNT_IF(aqi IS NOT NULL AND NOT (aqi BETWEEN lower_fence AND upper_fence)) AS BIGINT) AS n_outliers
FROM f JOIN readings r USING (queried_city) GROUP BY ALL""")
def q_box_stats(spark, sf_dir):
    return profile.box_stats(readings(spark, sf_dir))


@query("hour_profile", with_views(READINGS) + f"""
SELECT queried_city, CAST(hour(measured_at) AS INTEGER) AS hour, {xavg('aqi')} AS avg_aqi, COUNT(aqi) AS n
FROM readings GROUP BY 1, 2""")
def q_hour_profile(spark, sf_dir):
    return profile.profile_by(readings(spark, sf_dir), ["queried_city", F.hour("measured_at").alias("hour")])


def _pivot_sql(row_expr: str, row_name: str, col: str, values, src: str) -> str:
    cols = ", ".join(f"{xavg(f'CASE WHEN {col} = {v!r} THEN aqi END')} AS \"{v}\"" for v in values)
    return f"SELECT {row_expr} AS {row_name}, {cols} FROM {src} GROUP BY 1"


@query("weekday_pivot", with_views(READINGS) + "\n" + _pivot_sql(
    "CAST((dayofweek(measured_at) + 6) % 7 AS INTEGER)", "weekday", "queried_city", [*K.EXPECTED_CITIES, "other"],
    f"(SELECT * REPLACE (CASE WHEN queried_city IN ({', '.join(map(repr, K.EXPECTED_CITIES))}) THEN queried_city ELSE 'other' END "
    "AS queried_city) FROM readings) r"))
def q_weekday_pivot(spark, sf_dir):
    r = readings(spark, sf_dir)
    return profile.pivot_mean(r, weekday_mon0("measured_at").alias("weekday"), "queried_city", K.EXPECTED_CITIES, other="other")


_MONTHS = list(range(1, 13))


@query("month_pivot", with_views(YEARLY, """
ym AS (SELECT *, CAST(month(measured_at) AS INTEGER) AS m FROM yearly)""") + "\n" + ", ".join(
    ["SELECT queried_city"] + [f"{xavg(f'CASE WHEN m = {v} THEN aqi END')} AS \"{v}\"" for v in _MONTHS])
    + " FROM ym GROUP BY 1")
def q_month_pivot(spark, sf_dir):
    y = yearly_readings(spark, sf_dir).withColumn("m", F.month("measured_at"))
    return profile.pivot_mean(y, "queried_city", "m", _MONTHS)


@query("pollutant_share", with_views(READINGS, """
c AS (SELECT queried_city, dominant_pollutant, COUNT(*) AS n FROM readings GROUP BY 1, 2)""") + """
SELECT *, n / SUM(n) OVER (PARTITION BY queried_city) * 100.0 AS share_pct FROM c""")
def q_pollutant_share(spark, sf_dir):
    return profile.share_within(readings(spark, sf_dir), "queried_city", "dominant_pollutant")


@query("station_map", with_views(READINGS, STATIONS, f"""
a AS (SELECT waqi_idx, {xavg('aqi')} AS avg_aqi, COUNT(*) AS n FROM readings GROUP BY 1)""") + """
SELECT a.waqi_idx, s.station_name, s.lat, s.lon, a.avg_aqi, a.n FROM a JOIN stations s USING (waqi_idx)
WHERE s.lat BETWEEN 10 AND 21 AND s.lon BETWEEN 103 AND 108""")
def q_station_map(spark, sf_dir):
    a = readings(spark, sf_dir).groupBy("waqi_idx").agg(exact_avg("aqi").alias("avg_aqi"),
                                                          F.count(F.lit(1)).alias("n"))
    st = in_box(stations(spark, sf_dir), (10, 21), (103, 108))
    return a.join(st.select("waqi_idx", "station_name", "lat", "lon"), "waqi_idx")


_COORDS = " ".join(f"WHEN '{c}' THEN {{{i}}}" for i, c in enumerate(K.CITY_COORDS))


def _coord_sql(part: int) -> str:
    return f"CASE queried_city {_COORDS.format(*[repr(p[part]) for p in K.CITY_COORDS.values()])} END"


@query("city_points", with_views(READINGS) + f"""
SELECT queried_city, CAST({_coord_sql(0)} AS DOUBLE) AS lat, CAST({_coord_sql(1)} AS DOUBLE) AS lon, {xavg('aqi')} AS avg_aqi
FROM readings GROUP BY 1""")
def q_city_points(spark, sf_dir):
    """Map markers: every city's mean with its coordinates."""
    from smogline.functions.columns import label_lookup

    means = readings(spark, sf_dir).groupBy("queried_city").agg(exact_avg("aqi").alias("avg_aqi"))
    lat, lon = ({c: p[i] for c, p in K.CITY_COORDS.items()} for i in (0, 1))
    return means.select("queried_city", label_lookup("queried_city", lat).cast("double").alias("lat"),
                        label_lookup("queried_city", lon).cast("double").alias("lon"), "avg_aqi")


_LATEST_COLS = ["aqi", "pm25", "pm10", "dominant_pollutant"]


@query("latest_by_city", with_views(READINGS, """
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY measured_at DESC, waqi_idx DESC) AS rn FROM readings)""")
    + "\nSELECT queried_city, " + ", ".join(
        f"(SELECT x.{c} FROM (SELECT {c}, ROW_NUMBER() OVER (ORDER BY measured_at DESC, waqi_idx DESC) AS k "
        f"FROM readings i WHERE i.queried_city = g.queried_city AND i.{c} IS NOT NULL) x WHERE k = 1) AS {c}"
        for c in _LATEST_COLS) + " FROM (SELECT DISTINCT queried_city FROM readings) g")
def q_latest_by_city(spark, sf_dir):
    return profile.latest_non_null(readings(spark, sf_dir), "queried_city", _LATEST_COLS, ["measured_at", "waqi_idx"])


@query("annual_summary", with_views(YEARLY, daily_ctes("yearly"), f"""
an AS (SELECT queried_city, year, {ravg('avg_aqi')} AS avg_aqi, MAX(max_aqi) AS max_aqi,
         CAST(COUNT_IF(pollution_level = 'Good') AS BIGINT) AS days_good,
         CAST(COUNT_IF(pollution_level IN ('Unhealthy', 'Very Unhealthy', 'Hazardous')) AS BIGINT) AS days_unhealthy
       FROM daily GROUP BY 1, 2)""") + """
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year ORDER BY avg_aqi DESC, queried_city) AS INTEGER) AS overall_rank FROM an""")
def q_annual_summary(spark, sf_dir):
    d = gold.daily_summary(yearly_readings(spark, sf_dir))
    an = d.groupBy("queried_city", "year").agg(
        rounded_avg("avg_aqi").alias("avg_aqi"), F.max("max_aqi").alias("max_aqi"),
        F.count_if(F.col("pollution_level") == "Good").alias("days_good"),
        F.count_if(F.col("pollution_level").isin("Unhealthy", "Very Unhealthy", "Hazardous")).alias("days_unhealthy"))
    w = Window.partitionBy("year").orderBy(F.col("avg_aqi").desc(), F.col("queried_city"))
    return an.withColumn("overall_rank", F.row_number().over(w))


@query("city_ranking_yearly", with_views(YEARLY, daily_ctes("yearly")) + monthly_ctes("yearly"))
def q_city_ranking_yearly(spark, sf_dir):
    return gold.monthly_ranking(yearly_readings(spark, sf_dir))


@query("level_counts", _DAILY_SQL + """
SELECT queried_city, pollution_level, COUNT(*) AS n_days FROM daily GROUP BY 1, 2""")
def q_level_counts(spark, sf_dir):
    d = gold.daily_summary(readings(spark, sf_dir))
    return d.groupBy("queried_city", "pollution_level").agg(F.count(F.lit(1)).alias("n_days"))


@query("aqi_histogram", with_views(READINGS) + """
SELECT queried_city, floor(aqi / 25.0) * 25.0 AS bin_start, COUNT(*) AS n FROM readings WHERE aqi IS NOT NULL GROUP BY 1, 2""")
def q_aqi_histogram(spark, sf_dir):
    return profile.histogram(readings(spark, sf_dir), "aqi", 25.0, ["queried_city"])


@query("order_quantiles", "SELECT o_orderpriority, " + ", ".join(
    f"{r6(f'quantile_cont(CAST(o_totalprice AS DOUBLE), {p})')} AS {n}" for p, n in [(0.25, "p25"), (0.5, "p50"), (0.95, "p95")])
    + " FROM orders GROUP BY 1")
def q_order_quantiles(spark, sf_dir):
    """Quantiles of near-unique values: the running count is dealt out by value, not by key."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderpriority", F.col("o_totalprice").cast("double"))
    return profile.exact_quantiles(orders, ["o_orderpriority"], "o_totalprice", [0.25, 0.5, 0.95], ["p25", "p50", "p95"])


@query("aqi_p95", with_views(READINGS) + f"\nSELECT {_q('aqi', 0.95)} AS p95 FROM readings")
def q_aqi_p95(spark, sf_dir):
    return profile.exact_quantiles(readings(spark, sf_dir), [], "aqi", [0.95], ["p95"])


@query("dashboard_monthly", with_views(READINGS, f"""
dd AS (SELECT queried_city, CAST(measured_at AS DATE) AS "date", {xavg('aqi')} AS avg_aqi, MAX(aqi) AS max_aqi,
         {xavg('pm25')} AS avg_pm25 FROM readings GROUP BY 1, 2),
mo AS (SELECT queried_city, CAST(year("date") AS INTEGER) AS year, CAST(month("date") AS INTEGER) AS month,
         {xavg('avg_aqi')} AS avg_aqi, MAX(max_aqi) AS max_aqi, {xavg('avg_pm25')} AS avg_pm25 FROM dd GROUP BY 1, 2, 3)""") + f"""
SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY year, month ORDER BY avg_aqi DESC) AS INTEGER) AS aqi_rank,
  {level('avg_aqi')} AS pollution_level FROM mo""")
def q_dashboard_monthly(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("date", F.to_date("measured_at"))
    dd = r.groupBy("queried_city", "date").agg(exact_avg("aqi").alias("avg_aqi"), F.max("aqi").alias("max_aqi"),
                                               exact_avg("pm25").alias("avg_pm25"))
    mo = dd.groupBy("queried_city", F.year("date").alias("year"), F.month("date").alias("month")).agg(
        exact_avg("avg_aqi").alias("avg_aqi"), F.max("max_aqi").alias("max_aqi"), exact_avg("avg_pm25").alias("avg_pm25"))
    w = Window.partitionBy("year", "month").orderBy(F.col("avg_aqi").desc())
    return mo.withColumn("aqi_rank", F.dense_rank().over(w)).withColumn("pollution_level", aqi_level("avg_aqi"))


# --- rank correlation and mutual information ------------------------------------------
_CORR_COLS = ["aqi", "pm25", "pm10", "humidity", "temperature", "pressure", "wind"]


def _spearman_sql() -> str:
    from itertools import combinations

    parts = []
    for a, b in combinations(_CORR_COLS, 2):
        parts.append(f"""SELECT '{a}' AS a, '{b}' AS b, {r6('corr(rx, ry)')} AS rho, COUNT(*) AS n FROM (
  SELECT RANK() OVER (ORDER BY {a}) + (COUNT(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS rx,
         RANK() OVER (ORDER BY {b}) + (COUNT(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS ry
  FROM readings WHERE {a} IS NOT NULL AND {b} IS NOT NULL) t""")
    return with_views(READINGS) + "\n" + "\nUNION ALL\n".join(parts)


@query("spearman", _spearman_sql())
def q_spearman(spark, sf_dir):
    from smogline.operators.stats import spearman

    return spearman(readings(spark, sf_dir), _CORR_COLS)


_MI_FEATURES = ["pm10", "humidity", "temperature", "pressure", "wind"]


def _mi_sql() -> str:
    cols = _MI_FEATURES + ["aqi"]
    probs = [i / 10 for i in range(1, 10)]
    unp = "\nUNION ALL\n".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v, aqi AS t FROM readings "
                               f"WHERE {c} IS NOT NULL AND aqi IS NOT NULL" for c in cols)
    edges = ", ".join(f"{r6(f'quantile_cont(v, {p})')} AS e{i + 1}" for i, p in enumerate(probs))
    bx = " + ".join(f"CASE WHEN v > e{i} THEN 1 ELSE 0 END" for i in range(1, 10))
    by = " + ".join(f"CASE WHEN t > (SELECT e{i} FROM ed WHERE col = 'aqi') THEN 1 ELSE 0 END" for i in range(1, 10))
    return with_views(READINGS, f"""
lg AS ({unp}),
ed AS (SELECT col, {edges} FROM lg GROUP BY col),
bn AS (SELECT lg.col, {bx} AS bx, {by} AS b_y FROM lg JOIN ed USING (col)),
j AS (SELECT col, bx, b_y, COUNT(*) AS nxy FROM bn GROUP BY ALL),
jj AS (SELECT *, SUM(nxy) OVER (PARTITION BY col) AS n, SUM(nxy) OVER (PARTITION BY col, bx) AS nx,
         SUM(nxy) OVER (PARTITION BY col, b_y) AS ny FROM j),
mi AS (SELECT col AS feature, {r6('SUM((nxy / n) * ln((nxy * n) / (nx * ny)))')} AS mutual_info
       FROM jj WHERE col <> 'aqi' GROUP BY 1)""") + """
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY mutual_info DESC, feature) AS INTEGER) AS rank FROM mi"""


@query("mutual_info", _mi_sql())
def q_mutual_info(spark, sf_dir):
    from smogline.operators.stats import binned_mutual_info

    return binned_mutual_info(readings(spark, sf_dir), _MI_FEATURES, "aqi")


@query("city_filter", with_views(READINGS) + f"""
SELECT queried_city, date_trunc('day', measured_at) AS measured_at, {xavg('aqi')} AS aqi, {xavg('pm25')} AS pm25
FROM readings WHERE queried_city IN ('ha-noi', 'ho-chi-minh-city') GROUP BY 1, 2""")
def q_city_filter(spark, sf_dir):
    from smogline.operators.clean import in_cities
    from smogline.operators.windows import daily_means

    r = in_cities(readings(spark, sf_dir), ["ha-noi", "ho-chi-minh-city"])
    return daily_means(r, measures=["aqi", "pm25"])


def _label_sql(x: str) -> str:
    arms = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in K.CITY_LABELS.items())
    return f"CASE {arms} ELSE {x} END"


def _color_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in K.AQI_LEVEL_COLORS.items()) + " END"


_DASH_MEASURES = ["pm25", "pm10", "temperature", "humidity", "pressure", "wind"]


@query("dashboard_daily", with_views(READINGS, f"""
dd AS (SELECT queried_city, {_label_sql('queried_city')} AS city_label, CAST(measured_at AS DATE) AS "date",
         {xavg('aqi')} AS avg_aqi, MAX(aqi) AS max_aqi, MIN(aqi) AS min_aqi,
         {', '.join(f"{xavg(m)} AS avg_{m}" for m in _DASH_MEASURES)}
       FROM readings GROUP BY 1, 2, 3),
lv AS (SELECT *, {level('avg_aqi')} AS pollution_level FROM dd)""") + f"""
SELECT *, {_color_sql('pollution_level')} AS aqi_color, CAST(month("date") AS INTEGER) AS month,
  CAST(year("date") AS INTEGER) AS year FROM lv""")
def q_dashboard_daily(spark, sf_dir):
    from smogline.functions.columns import label_lookup

    r = readings(spark, sf_dir).withColumn("date", F.to_date("measured_at"))
    d = r.groupBy("queried_city", label_lookup("queried_city", K.CITY_LABELS).alias("city_label"), "date").agg(
        exact_avg("aqi").alias("avg_aqi"), F.max("aqi").alias("max_aqi"), F.min("aqi").alias("min_aqi"),
        *[exact_avg(m).alias(f"avg_{m}") for m in _DASH_MEASURES])
    d = d.withColumn("pollution_level", aqi_level("avg_aqi"))
    return d.withColumns({"aqi_color": label_lookup("pollution_level", K.AQI_LEVEL_COLORS),
                          "month": F.month("date"), "year": F.year("date")})


_POLLUTANTS = ["pm25", "pm10", "o3"]


@query("pollutant_pivot", with_views(READINGS) + "\nSELECT queried_city, " + ", ".join(
    f"CAST(COUNT_IF(dominant_pollutant = '{p}') AS BIGINT) AS {p}" for p in _POLLUTANTS) + f""",
  CAST(COUNT_IF(dominant_pollutant NOT IN ({", ".join(repr(p) for p in _POLLUTANTS)})) AS BIGINT) AS other,
  CAST(COUNT_IF(dominant_pollutant IS NULL) AS BIGINT) AS missing FROM readings GROUP BY 1""")
def q_pollutant_pivot(spark, sf_dir):
    """Counts per category; categories without a column of their own are ``other``, nulls ``missing``."""
    r, columns = readings(spark, sf_dir), [*_POLLUTANTS, "other", "missing"]
    p = F.col("dominant_pollutant")
    shown = F.when(p.isNull(), "missing").when(p.isin(_POLLUTANTS), p).otherwise("other")
    return r.withColumn("shown", shown).groupBy("queried_city").pivot("shown", columns).count().fillna(0, columns)


@query("aqi_correlations", "WITH sp AS (" + _spearman_sql() + """)
SELECT CASE WHEN a = 'aqi' THEN b ELSE a END AS feature, rho,
  CAST(ROW_NUMBER() OVER (ORDER BY abs(rho) DESC, CASE WHEN a = 'aqi' THEN b ELSE a END) AS INTEGER) AS rank
FROM sp WHERE a = 'aqi' OR b = 'aqi'""")
def q_aqi_correlations(spark, sf_dir):
    from smogline.operators.stats import rank_by_abs, spearman

    return rank_by_abs(spearman(readings(spark, sf_dir), _CORR_COLS, target="aqi"), "aqi")
