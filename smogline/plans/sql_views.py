"""SQL text of the adapter views, for the DuckDB oracle (same logic as sources.testdata)."""

READINGS = """
readings AS (
  SELECT CAST(user_id * 5 + c AS INT) AS waqi_idx, CAST(ts AS TIMESTAMP) AS measured_at,
    CASE c WHEN 0 THEN 'ha-noi' WHEN 1 THEN 'ho-chi-minh-city' WHEN 2 THEN 'da-nang'
           WHEN 3 THEN 'gia-lai' ELSE 'cao-bang' END AS queried_city,
    value AS aqi,
    CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 5 < 3 THEN 'pm25'
         WHEN event_id % 5 = 3 THEN 'pm10' ELSE 'o3' END AS dominant_pollutant,
    value * CAST(0.7 AS DOUBLE) AS pm25,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE value * CAST(0.9 AS DOUBLE) END AS pm10,
    CAST(40 + k % 50 AS DOUBLE) AS humidity, CAST(15 + k % 20 AS DOUBLE) AS temperature,
    CAST(1000 + k % 30 AS DOUBLE) AS pressure, CAST(k % 10 AS DOUBLE) AS wind,
    CASE WHEN event_id % 2 = 0 THEN 'kaggle' ELSE 'api' END AS source,
    event_id
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
    CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2
                    WHEN 'signup' THEN 3 ELSE 4 END AS c FROM events) e
)"""

STATIONS = """
stations AS (
  SELECT CAST(c_custkey * 5 + c AS INT) AS waqi_idx,
    concat(c_name, '-', CAST(c AS VARCHAR)) AS station_name,
    CASE c WHEN 0 THEN 'ha-noi' WHEN 1 THEN 'ho-chi-minh-city' WHEN 2 THEN 'da-nang'
           WHEN 3 THEN 'gia-lai' ELSE 'cao-bang' END AS queried_city,
    CAST(8 + c_custkey % 16 AS DOUBLE) AS lat, CAST(102 + c_custkey % 8 AS DOUBLE) AS lon
  FROM customer CROSS JOIN (SELECT 0 AS c UNION ALL SELECT 1 UNION ALL SELECT 2
                            UNION ALL SELECT 3 UNION ALL SELECT 4) t
)"""

READINGS_DUP = """
readings_dup AS (
  SELECT *, '2024-02-01T00:00:00' AS ingested_at FROM readings
  UNION ALL
  SELECT * REPLACE (aqi + 1.0 AS aqi), '2024-02-02T06:00:00' AS ingested_at FROM readings WHERE event_id % 17 = 0
)"""

def scaled(x: str) -> str:
    """Oracle form of functions.columns.scaled: units of 1e-6, half-even, long-backed decimal."""
    return f"CAST(CAST(round_even({x} * CAST(1000000 AS DOUBLE), 0) AS BIGINT) AS DECIMAL(18,0))"


def xmean(scaled_sum: str, count: str) -> str:
    return f"(CAST({scaled_sum} AS DOUBLE) / CAST(1000000 AS DOUBLE) / {count})"


def xavg(x: str) -> str:
    return xmean(f"SUM({scaled(x)})", f"COUNT({x})")


# 2-digit mean that both engines round identically (exact scaled sum, 1e-9 nudge)
def ravg(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND({xavg(x)} + 1e-9, {digits}) AS DOUBLE)"


def level(x: str) -> str:
    return (f"CASE WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate' "
            f"WHEN {x} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 200 THEN 'Unhealthy' "
            f"WHEN {x} <= 300 THEN 'Very Unhealthy' WHEN {x} IS NOT NULL THEN 'Hazardous' END")


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views)


def _spelling_sql() -> str:
    from smogline.sources.testdata import NAME_SPELLINGS

    parts = []
    for ci, names in enumerate(NAME_SPELLINGS):
        for vi, name in enumerate(names):
            parts.append(f"WHEN waqi_idx % 5 = {ci} AND event_id % 3 = {vi} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


def _slug_sql() -> str:
    from smogline.sources.testdata import URL_SLUGS

    return "CASE " + " ".join(f"WHEN waqi_idx % 5 = {i} THEN '{s}'" for i, s in enumerate(URL_SLUGS)) + " END"


READINGS_DIRTY = f"""
dirty AS (
  SELECT event_id, CAST(waqi_idx AS VARCHAR) AS station_id,
    CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(aqi AS VARCHAR) END AS aqi_index,
    CASE WHEN event_id % 37 = 0 THEN '-'
         ELSE CAST(8 + waqi_idx % 16 AS VARCHAR) || ',' || CAST(102 + waqi_idx % 8 AS VARCHAR) END AS location,
    {_spelling_sql()} || ' station ' || CAST(waqi_idx AS VARCHAR) AS station_name,
    CASE WHEN event_id % 31 = 0 THEN 'https://aqi.example/feed/unknown'
         ELSE 'https://aqi.example/city/vietnam/' || {_slug_sql()} || '/station-' || CAST(waqi_idx AS VARCHAR) || '/' END AS url,
    CASE WHEN event_id % 23 = 0 THEN '#NAME?' WHEN event_id % 19 = 0 THEN 'aqi'
         ELSE coalesce(dominant_pollutant, '-') END AS dominent_pollutant,
    CASE WHEN event_id % 7 = 0 THEN 'N/A' ELSE CAST(humidity AS VARCHAR) END AS humidity,
    substr(CAST(CAST(pressure AS INT) AS VARCHAR), 1, 1) || ',' || substr(CAST(CAST(pressure AS INT) AS VARCHAR), 2, 3) AS pressure,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(pm10 AS VARCHAR) END AS pm10,
    CAST(pm25 AS VARCHAR) AS pm25, CAST(temperature AS VARCHAR) AS temperature, CAST(wind AS VARCHAR) AS wind,
    CASE WHEN event_id % 41 = 0 THEN 'not a time'
         ELSE strftime(measured_at + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') END AS data_time_s,
    '+07:00' AS data_time_tz
  FROM readings
)"""


def num(x: str) -> str:
    """Oracle form of parse_number: tokens -> null, drop thousands commas, try-cast."""
    t = f"trim({x})"
    return f"TRY_CAST(replace(CASE WHEN {t} IN ('-', '', '#NAME?', 'N/A') THEN NULL ELSE {t} END, ',', '') AS DOUBLE)"


def keyword_case(x: str, table, lower: bool = False, default: str = "NULL", null_label: str = "NULL") -> str:
    probe = f"lower({x})" if lower else x
    arms = []
    for label, words in table.items():
        cond = " OR ".join(f"contains({probe}, '{(w.lower() if lower else w)}')" for w in words)
        arms.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE WHEN {x} IS NULL THEN {null_label} " + " ".join(arms) + f" ELSE {default} END"


HOURLY_MEASURES_SQL = ["aqi", "pm25", "pm10", "temperature", "humidity", "pressure", "wind"]


def hourly_cte(name: str = "h", unit: str = "hour") -> str:
    avgs = ", ".join(f"{xavg(m)} AS {m}" for m in HOURLY_MEASURES_SQL)
    return f"""
{name} AS (SELECT queried_city, date_trunc('{unit}', measured_at) AS measured_at, {avgs}
      FROM readings GROUP BY 1, 2 HAVING {xavg('aqi')} IS NOT NULL)"""


def r6(x: str, digits: int = 6) -> str:
    return f"round({x} + 1e-9, {digits})"


def roll_sql(col: str, n: int, label: str, stats=("mean", "std", "min", "max"), need: int = 1,
             include_current: bool = False, std_null_as=None, w: str = "w") -> list[str]:
    frame = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" if include_current \
        else f"({w} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    cnt = f"COUNT({col}) OVER {frame}"
    exprs = {
        "mean": r6(xmean(f"SUM({scaled(col)}) OVER {frame}", cnt)),
        "std": r6(f"stddev_samp({col}) OVER {frame}"),
        "min": f"MIN({col}) OVER {frame}",
        "max": f"MAX({col}) OVER {frame}",
    }
    out = []
    for s in stats:
        e = f"CASE WHEN {cnt} >= {need} THEN {exprs[s]} END"
        if s == "std" and std_null_as is not None:
            e = f"coalesce({e}, {float(std_null_as)})"
        out.append(f"{e} AS {col}_roll_{s}_{label}")
    return out


TWO_PI = "CAST(6.283185307179586 AS DOUBLE)"


YEARLY = """
yearly AS (
  SELECT CAST(o_custkey * 5 + c AS INT) AS waqi_idx, CAST(o_orderdate AS TIMESTAMP) AS measured_at,
    CASE c WHEN 0 THEN 'ha-noi' WHEN 1 THEN 'ho-chi-minh-city' WHEN 2 THEN 'da-nang'
           WHEN 3 THEN 'gia-lai' ELSE 'cao-bang' END AS queried_city,
    o_totalprice / 1000.0 AS aqi,
    CASE o_orderstatus WHEN 'F' THEN 'pm25' WHEN 'O' THEN 'pm10' ELSE 'o3' END AS dominant_pollutant,
    (o_totalprice / 1000.0) * CAST(0.7 AS DOUBLE) AS pm25, (o_totalprice / 1000.0) * CAST(0.9 AS DOUBLE) AS pm10,
    CAST(40 + o_orderkey % 50 AS DOUBLE) AS humidity, CAST(15 + o_orderkey % 20 AS DOUBLE) AS temperature,
    'kaggle' AS source, o_orderkey AS event_id
  FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
                  WHEN '4-NOT SPECIFIED' THEN 3 ELSE 4 END AS c FROM orders) o
)"""
