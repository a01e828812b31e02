"""Feature-table queries: hourly means, lags, trailing stats, grid, interpolation, fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import robust as R
from smogline.operators import segments as S
from smogline.operators import windows as W
from smogline.plans.registry import ORACLE, query
from smogline.plans.sql_views import READINGS, TWO_PI, hourly_cte, r6, roll_sql, scaled, with_views, xavg, xmean
from smogline.sources.testdata import readings

WIN = "WINDOW w AS (PARTITION BY queried_city ORDER BY measured_at)"


def _hourly(spark, sf_dir):
    return W.hourly(readings(spark, sf_dir))


@query("hourly", with_views(READINGS, hourly_cte()) + "\nSELECT * FROM h")
def q_hourly(spark, sf_dir):
    return _hourly(spark, sf_dir)


_LAGS_SQL = ", ".join(f"LAG({c}, {n}) OVER w AS {c}_lag_{n}h" for n in K.HOURLY_LAGS for c in ("aqi", "pm25"))


@query("lag_features", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, aqi, pm25, {_LAGS_SQL} FROM h {WIN}""")
def q_lag_features(spark, sf_dir):
    h = _hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi", "pm25")
    return h.withColumns(W.lag_columns(["aqi", "pm25"], K.HOURLY_LAGS, W._w("queried_city", "measured_at")))


_ROLL_SQL = ", ".join(e for n, lab in K.HOURLY_ROLLING for e in roll_sql("aqi", n, lab))


@query("rolling_features", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, aqi, {_ROLL_SQL} FROM h {WIN}""")
def q_rolling_features(spark, sf_dir):
    h = _hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi")
    return h.withColumns(W.rolling_columns("aqi", K.HOURLY_ROLLING, W._w("queried_city", "measured_at")))


_CHANGE_SQL = """aqi - LAG(aqi, 1) OVER w AS aqi_diff_1h,
  (aqi - LAG(aqi, 24) OVER w) / NULLIF(LAG(aqi, 24) OVER w, 0.0) AS aqi_pct_change_24h"""


@query("change_features", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, aqi, {_CHANGE_SQL} FROM h {WIN}""")
def q_change_features(spark, sf_dir):
    h = _hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi")
    return h.withColumns(W.change_columns("aqi", W._w("queried_city", "measured_at")))


_TIME_SQL = f"""CAST(hour(measured_at) AS INTEGER) AS hour, CAST(dayofweek(measured_at) + 1 AS INTEGER) AS dow,
  CAST(month(measured_at) AS INTEGER) AS month,
  CASE WHEN dayofweek(measured_at) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(measured_at) IN (11, 12, 1, 2, 3, 4) THEN 1 ELSE 0 END AS is_dry_season,
  sin({TWO_PI} * hour(measured_at) / 24.0) AS hour_sin, cos({TWO_PI} * hour(measured_at) / 24.0) AS hour_cos,
  sin({TWO_PI} * month(measured_at) / 12.0) AS month_sin, cos({TWO_PI} * month(measured_at) / 12.0) AS month_cos"""


@query("time_features", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, {_TIME_SQL} FROM h""")
def q_time_features(spark, sf_dir):
    return _hourly(spark, sf_dir).select("queried_city", "measured_at").withColumns(W.time_columns())


@query("forecast_target", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, aqi, LEAD(aqi, 24) OVER w AS aqi_target FROM h {WIN}""")
def q_forecast_target(spark, sf_dir):
    h = _hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi")
    return h.withColumn("aqi_target", F.lead("aqi", 24).over(W._w("queried_city", "measured_at")))


@query("feature_table", with_views(READINGS, hourly_cte()) + f"""
SELECT *, {_LAGS_SQL}, {_ROLL_SQL}, {_CHANGE_SQL}, {_TIME_SQL}, LEAD(aqi, 24) OVER w AS aqi_target,
  CAST(year(measured_at) AS VARCHAR) AS year, lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month_part
FROM h {WIN}""")
def q_feature_table(spark, sf_dir):
    return W.hourly_features(_hourly(spark, sf_dir))


_GRID_SQL = """
b AS (SELECT queried_city, MIN(measured_at) AS lo, MAX(measured_at) AS hi FROM h GROUP BY 1),
g AS (SELECT queried_city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS measured_at FROM b),
gh AS (SELECT g.queried_city, g.measured_at, h.* EXCLUDE (queried_city, measured_at)
       FROM g LEFT JOIN h ON g.queried_city = h.queried_city AND g.measured_at = h.measured_at)"""


@query("regularize", with_views(READINGS, hourly_cte(), _GRID_SQL) + "\nSELECT * FROM gh")
def q_regularize(spark, sf_dir):
    return W.regularize(_hourly(spark, sf_dir))


def _interp_sql(c: str, limit: int = 6) -> str:
    bef = "(w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    aft = "(w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    t = "CAST(epoch(measured_at) AS BIGINT)"
    pv = f"LAST_VALUE({c} IGNORE NULLS) OVER {bef}"
    pt = f"LAST_VALUE(CASE WHEN {c} IS NOT NULL THEN {t} END IGNORE NULLS) OVER {bef}"
    prn = f"LAST_VALUE(CASE WHEN {c} IS NOT NULL THEN _rn END IGNORE NULLS) OVER {bef}"
    nv = f"FIRST_VALUE({c} IGNORE NULLS) OVER {aft}"
    nt = f"FIRST_VALUE(CASE WHEN {c} IS NOT NULL THEN {t} END IGNORE NULLS) OVER {aft}"
    lin = f"{pv} + ({nv} - {pv}) * CAST(({t} - {pt}) AS DOUBLE) / CAST(({nt} - {pt}) AS DOUBLE)"
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN _rn - {prn} <= {limit} THEN "
            f"(CASE WHEN {nv} IS NULL THEN {pv} ELSE {r6(lin)} END) END AS {c}")


@query("interpolate", with_views(READINGS, hourly_cte(), _GRID_SQL, """
gn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY measured_at) AS _rn FROM gh)""") + f"""
SELECT queried_city, measured_at, {', '.join(_interp_sql(c) for c in K.HOURLY_MEASURES)} FROM gn {WIN}""")
def q_interpolate(spark, sf_dir):
    g = W.regularize(_hourly(spark, sf_dir))
    return W.interpolate(g, K.HOURLY_MEASURES, limit=6)


@query("fill_gaps", with_views(READINGS, hourly_cte(), _GRID_SQL, """
med AS (SELECT queried_city, median(pm10) AS m_pm10, median(aqi) AS m_aqi FROM gh GROUP BY 1)""") + """
SELECT gh.queried_city, gh.measured_at,
  coalesce(gh.pm10, LAST_VALUE(gh.pm10 IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           FIRST_VALUE(gh.pm10 IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), m_pm10) AS pm10,
  coalesce(gh.aqi, LAST_VALUE(gh.aqi IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           FIRST_VALUE(gh.aqi IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), m_aqi) AS aqi
FROM gh JOIN med USING (queried_city)
WINDOW w AS (PARTITION BY gh.queried_city ORDER BY gh.measured_at)""")
def q_fill_gaps(spark, sf_dir):
    g = W.regularize(_hourly(spark, sf_dir)).select("queried_city", "measured_at", "pm10", "aqi")
    return W.fill_forward_back_median(g, ["pm10", "aqi"])


def _daily_sql() -> str:
    lags = ", ".join(f"LAG(aqi, {n}) OVER w AS aqi_lag_{n}d" for n in K.DAILY_LAGS)
    rolls = ", ".join(e for n, lab in K.DAILY_ROLLING
                      for e in roll_sql("aqi", n, lab, stats=("mean", "std"), need=max(1, n // 2), std_null_as=0.0))
    dow = "((dayofweek(measured_at) + 6) % 7)"
    return f"""SELECT *, {lags}, {rolls}, aqi - LAG(aqi, 1) OVER w AS aqi_diff_1d,
  sin({TWO_PI} * month(measured_at) / 12.0) AS month_sin, cos({TWO_PI} * month(measured_at) / 12.0) AS month_cos,
  sin({TWO_PI} * {dow} / 7.0) AS dow_sin, cos({TWO_PI} * {dow} / 7.0) AS dow_cos,
  CASE WHEN {dow} >= 5 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(measured_at) IN (11, 12, 1, 2, 3, 4) THEN 1 ELSE 0 END AS is_dry_season,
  LEAD(aqi, 1) OVER w AS aqi_target
FROM d {WIN}"""


@query("daily_features", with_views(READINGS, hourly_cte("d", "day")) + "\n" + _daily_sql())
def q_daily_features(spark, sf_dir):
    return W.daily_features(readings(spark, sf_dir))


@query("rolling_7d", with_views(READINGS, hourly_cte("d", "day")) + f"""
SELECT queried_city, measured_at, aqi,
  {r6(xmean(f"SUM({scaled('aqi')}) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", "COUNT(aqi) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"))} AS aqi_roll_7
FROM d {WIN}""")
def q_rolling_7d(spark, sf_dir):
    d = W.daily_means(readings(spark, sf_dir)).select("queried_city", "measured_at", "aqi")
    return W.rolling_mean_including_current(d, "aqi", 7, name="aqi_roll_7")


_Z_ROLL = ", ".join(roll_sql("aqi", 168, "7d", stats=("mean", "std")))


@query("zscore_anomalies", with_views(READINGS, hourly_cte(), f"""
f AS (SELECT queried_city, measured_at, aqi, {_Z_ROLL} FROM h {WIN}),
z AS (SELECT *, {r6("(aqi - aqi_roll_mean_7d) / NULLIF(aqi_roll_std_7d, 0.0)")} AS zscore_7d FROM f)""") + """
SELECT *, CASE WHEN abs(zscore_7d) > 3.0 THEN 1 ELSE 0 END AS is_anom_zscore FROM z""")
def q_zscore_anomalies(spark, sf_dir):
    h = _hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi")
    f = h.withColumns(W.rolling_columns("aqi", [(168, "7d")], W._w("queried_city", "measured_at"), stats=("mean", "std")))
    return W.zscore_anomalies(f)


@query("decompose", with_views(READINGS, hourly_cte("h", "day"), _GRID_SQL.replace("1 HOUR", "1 DAY"), """
gn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY measured_at) AS _rn FROM gh)""", f"""
d AS (SELECT * REPLACE ({_interp_sql('aqi', 5)}) FROM gn {WIN})""", f"""
t AS (SELECT * EXCLUDE (_rn), (_rn - 1) % 7 AS _phase,
        CASE WHEN COUNT(aqi) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7 THEN
          {r6(xmean(f"SUM({scaled('aqi')}) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)", "CAST(7 AS DOUBLE)"))}
        END AS trend FROM d {WIN}),
pm AS (SELECT queried_city, _phase, AVG(aqi - trend) AS m FROM t GROUP BY 1, 2),
sc AS (SELECT queried_city, _phase, {r6("m - AVG(m) OVER (PARTITION BY queried_city)")} AS seasonal FROM pm)""") + f"""
SELECT t.* EXCLUDE (_phase), sc.seasonal, {r6("aqi - trend - seasonal")} AS resid
FROM t LEFT JOIN sc USING (queried_city, _phase) WHERE aqi IS NOT NULL""")
def q_decompose(spark, sf_dir):
    return W.decompose(W.daily_means(readings(spark, sf_dir)))


_SEQ_FEATS = ["aqi", "pm25", "humidity"]


@query("sequences", with_views(READINGS, hourly_cte(), f"""
s AS (SELECT queried_city, measured_at AS end_at, LEAD(aqi, 24) OVER w AS target,
        COUNT(*) OVER (w ROWS BETWEEN 71 PRECEDING AND CURRENT ROW) AS _n,
        MIN(CASE WHEN {' AND '.join(f'{f} IS NOT NULL' for f in _SEQ_FEATS)} THEN 1 ELSE 0 END)
          OVER (w ROWS BETWEEN 71 PRECEDING AND CURRENT ROW) AS _ok,
        {', '.join(f'list({f}) OVER (w ROWS BETWEEN 71 PRECEDING AND CURRENT ROW) AS seq_{f}' for f in _SEQ_FEATS)}
      FROM h {WIN})""") + """
SELECT * EXCLUDE (_n, _ok) FROM s WHERE _n = 72 AND _ok = 1 AND target IS NOT NULL""")
def q_sequences(spark, sf_dir):
    return W.sequences(_hourly(spark, sf_dir), _SEQ_FEATS, length=72, horizon=24)


def _grid_feature_sql() -> str:
    cols = ", ".join(_interp_sql(c) for c in K.HOURLY_MEASURES)
    rolls = ", ".join(e for n, lab in K.HOURLY_ROLLING for e in roll_sql("aqi", n, lab, need=n))
    change = """LAG(aqi, 1) OVER w - LAG(aqi, 2) OVER w AS aqi_diff_1h,
  (LAG(aqi, 1) OVER w - LAG(aqi, 25) OVER w) / NULLIF(LAG(aqi, 25) OVER w, 0.0) AS aqi_pct_change_24h"""
    return with_views(READINGS, hourly_cte(), _GRID_SQL, f"""
gn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY measured_at) AS _rn FROM gh),
gi AS (SELECT queried_city, measured_at, {cols} FROM gn {WIN})""") + f"""
SELECT *, {_LAGS_SQL}, {rolls}, {change}, {_TIME_SQL}, LEAD(aqi, 24) OVER w AS aqi_target,
  CAST(year(measured_at) AS VARCHAR) AS year, lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month_part
FROM gi {WIN}"""


@query("feature_table_grid", _grid_feature_sql())
def q_feature_table_grid(spark, sf_dir):
    """Grid mode, computed on 10-day buckets with a 7-day overlap (several buckets per city)."""
    return W.grid_features(_hourly(spark, sf_dir), bucket_steps=240)


# --- the same tables from series cut into segments of rows (any one city may hold most rows) ---
#: Rows of a segment here: several per city already on the small tables.
_SEGMENT = 240


@query("feature_table_split", ORACLE["feature_table"])
def q_feature_table_split(spark, sf_dir):
    return S.hourly_features(_hourly(spark, sf_dir), rows=_SEGMENT)


@query("zscore_split", ORACLE["zscore_anomalies"])
def q_zscore_split(spark, sf_dir):
    return S.zscore_anomalies(_hourly(spark, sf_dir).select("queried_city", "measured_at", "aqi"), rows=_SEGMENT)


@query("sequences_split", ORACLE["sequences"])
def q_sequences_split(spark, sf_dir):
    return S.sequences(_hourly(spark, sf_dir), _SEQ_FEATS, length=72, horizon=24, rows=_SEGMENT)


@query("regularize_split", ORACLE["regularize"])
def q_regularize_split(spark, sf_dir):
    return S.regularize(_hourly(spark, sf_dir), rows=_SEGMENT)


@query("interpolate_split", ORACLE["interpolate"])
def q_interpolate_split(spark, sf_dir):
    return S.interpolate(S.regularize(_hourly(spark, sf_dir), rows=_SEGMENT), K.HOURLY_MEASURES, limit=6, rows=_SEGMENT)


@query("fill_gaps_split", ORACLE["fill_gaps"])
def q_fill_gaps_split(spark, sf_dir):
    grid = S.regularize(_hourly(spark, sf_dir).select("queried_city", "measured_at", "pm10", "aqi"), rows=_SEGMENT)
    return S.fill(grid, ["pm10", "aqi"], rows=_SEGMENT)


def _line_sql(source: str, value: str, name: str, reach: int = R.REACH) -> list[str]:
    """The local line in SQL: lags, moments, value."""
    near = list(range(-reach, reach + 1))
    at = lambda c, d: f"coalesce({f'LEAD({c}, {d}) OVER w' if d > 0 else f'LAG({c}, {-d}) OVER w' if d else c}, 0.0)"
    lags = ", ".join(f"{at(s, d)} * CAST({R.tricube(d, reach)!r} AS DOUBLE) AS _{c}{i}" for i, d in enumerate(near)
                     for c, s in (("a", "weight"), ("b", f"(weight * coalesce({value}, 0.0))")))
    moment = lambda c, p: "0.0 + " + " + ".join(f"_{c}{i} * CAST({float(d ** p)!r} AS DOUBLE)" if p else f"_{c}{i}"
                                               for i, d in enumerate(near) if not p or d)
    line = "CASE WHEN s0 * s2 - s1 * s1 > 1e-6 * s0 * s0 THEN (t0 * s2 - t1 * s1) / (s0 * s2 - s1 * s1) ELSE t0 / NULLIF(s0, 0.0) END"
    return [f"{name}_l AS (SELECT *, {lags} FROM {source} {WIN})",
            f"{name}_m AS (SELECT *, {moment('a', 0)} AS s0, {moment('a', 1)} AS s1, {moment('a', 2)} AS s2, {moment('b', 0)} AS t0, "
            f"{moment('b', 1)} AS t1 FROM {name}_l)",
            f"{name} AS (SELECT queried_city, measured_at, aqi, _phase, weight, seasonal, {r6(line)} AS trend FROM {name}_m)"]


def _robust_sql() -> str:
    parts = [READINGS, hourly_cte("h", "day"), _GRID_SQL.replace("1 HOUR", "1 DAY"),
             "gn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city ORDER BY measured_at) AS _rn FROM gh)",
             f"gi AS (SELECT queried_city, measured_at, _rn, {_interp_sql('aqi', 5)} FROM gn {WIN})",
             "d0 AS (SELECT queried_city, measured_at, aqi, (_rn - 1) % 7 AS _phase, CASE WHEN aqi IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0 END AS weight, "
             "0.0::DOUBLE AS seasonal FROM gi)", *_line_sql("d0", "aqi", "t0r")]
    last = "t0r"
    for i in range(1, R.ROUNDS + 1):
        parts += [
            f"p{i} AS (SELECT queried_city, _phase, {r6('SUM(weight * (aqi - trend)) / NULLIF(SUM(weight), 0.0)')} AS m FROM {last} GROUP BY 1, 2)",
            f"s{i} AS (SELECT queried_city, _phase, {r6('coalesce(m, 0.0) - AVG(coalesce(m, 0.0)) OVER (PARTITION BY queried_city)')} AS seasonal FROM p{i})",
            f"j{i} AS (SELECT q.queried_city, q.measured_at, q.aqi, q._phase, q.weight, s{i}.seasonal FROM {last} q JOIN s{i} USING (queried_city, _phase))",
            *_line_sql(f"j{i}", "(aqi - seasonal)", f"t{i}r"),
            f"r{i} AS (SELECT *, {r6('aqi - trend - seasonal')} AS resid FROM t{i}r)",
            f"c{i} AS (SELECT queried_city, 6.0 * median(abs(resid)) AS scale FROM r{i} GROUP BY 1)",
            f"w{i} AS (SELECT r{i}.* EXCLUDE (weight), CASE WHEN aqi IS NULL THEN 0.0 WHEN abs(resid) / NULLIF(scale, 0.0) IS NULL THEN 1.0 "
            f"WHEN abs(resid) / NULLIF(scale, 0.0) >= 1 THEN 0.0 ELSE {r6('pow(1 - (abs(resid) / scale) * (abs(resid) / scale), 2.0)')} END AS weight "
            f"FROM r{i} JOIN c{i} USING (queried_city))"]
        last = f"w{i}"
    return with_views(*parts) + f"\nSELECT queried_city, measured_at, aqi, trend, seasonal, resid, weight FROM {last} WHERE aqi IS NOT NULL"


@query("robust_decompose", _robust_sql())
def q_robust_decompose(spark, sf_dir):
    """Daily means of every city: trend, weekday effect, residual, and the weight each day was given."""
    return R.robust_decompose(W.daily_means(readings(spark, sf_dir), measures=["aqi"]))
