"""Silver-layer queries: cleaning, flattening, dedup and upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions.columns import city_from_url, keyword_category, parse_number
from smogline.operators import clean, dedup
from smogline.plans.registry import query
from smogline.plans.sql_views import (
    READINGS, READINGS_DIRTY, READINGS_DUP, STATIONS, keyword_case, num, with_views,
)
from smogline.sources.testdata import api_documents, readings, readings_dirty, readings_dup, stations


@query("clean_numeric", with_views(READINGS, READINGS_DIRTY, f"""
SELECT event_id, {num('aqi_index')} AS aqi, {num('humidity')} AS humidity, {num('pressure')} AS pressure,
       {num('pm10')} AS pm10, {num('pm25')} AS pm25
FROM dirty"""))
def q_clean_numeric(spark, sf_dir):
    d = readings_dirty(spark, sf_dir)
    return d.select("event_id", *[parse_number(c).alias(a) for c, a in
                                  [("aqi_index", "aqi"), ("humidity", "humidity"), ("pressure", "pressure"),
                                   ("pm10", "pm10"), ("pm25", "pm25")]])


@query("city_from_name", with_views(READINGS, READINGS_DIRTY, f"""
SELECT {keyword_case('station_name', K.CITY_KEYWORDS_ETL)} AS city_etl,
       {keyword_case('station_name', K.CITY_KEYWORDS_ANALYSIS, lower=True, default="'other'", null_label="'unknown'")} AS city_analysis,
       COUNT(*) AS n
FROM dirty GROUP BY 1, 2"""))
def q_city_from_name(spark, sf_dir):
    d = readings_dirty(spark, sf_dir)
    etl = keyword_category("station_name", K.CITY_KEYWORDS_ETL)
    ana = keyword_category("station_name", K.CITY_KEYWORDS_ANALYSIS, case_insensitive=True,
                           default="other", null_label="unknown")
    return d.groupBy(etl.alias("city_etl"), ana.alias("city_analysis")).agg(F.count(F.lit(1)).alias("n"))


def _url_sql(x: str) -> str:
    g = f"regexp_extract({x}, '{K.URL_CITY_PATTERN}', 1)"
    arms = " ".join(f"WHEN {g} = '{k}' THEN '{v}'" for k, v in K.URL_CITY_ALIASES.items())
    return f"CASE WHEN {x} IS NULL OR {g} = '' THEN 'unknown' {arms} ELSE {g} END"


@query("city_from_url", with_views(READINGS, READINGS_DIRTY, f"""
SELECT {_url_sql('url')} AS queried_city, COUNT(*) AS n, COUNT(DISTINCT station_id) AS stations
FROM dirty GROUP BY 1"""))
def q_city_from_url(spark, sf_dir):
    d = readings_dirty(spark, sf_dir)
    return d.groupBy(city_from_url("url").alias("queried_city")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("station_id").alias("stations"))


@query("clean_station_rows", with_views(READINGS, READINGS_DIRTY, f"""
c AS (
  SELECT TRY_CAST(station_id AS INT) AS waqi_idx,
    CAST(try_strptime(data_time_s || ' ' || data_time_tz, '%Y-%m-%d %H:%M:%S %z') AS TIMESTAMP) AS measured_at,
    {num('aqi_index')} AS aqi,
    CASE WHEN trim(dominent_pollutant) IN ('-', '', '#NAME?', 'N/A', 'aqi') THEN NULL ELSE trim(dominent_pollutant) END AS dominant_pollutant,
    CAST(NULL AS DOUBLE) AS co, CAST(NULL AS DOUBLE) AS no2, CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS so2,
    {num('pm25')} AS pm25, {num('pm10')} AS pm10, {num('humidity')} AS humidity,
    {num('temperature')} AS temperature, {num('pressure')} AS pressure, {num('wind')} AS wind,
    'kaggle' AS source, '2024-02-01T00:00:00' AS ingested_at,
    {keyword_case('station_name', K.CITY_KEYWORDS_ETL)} AS queried_city,
    station_name, url,
    TRY_CAST(split_part(location, ',', 1) AS DOUBLE) AS lat,
    TRY_CAST(NULLIF(split_part(location, ',', 2), '') AS DOUBLE) AS lon
  FROM dirty)
SELECT *, CAST(year(measured_at) AS VARCHAR) AS year, lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month
FROM c WHERE queried_city IS NOT NULL AND waqi_idx IS NOT NULL AND measured_at IS NOT NULL AND aqi IS NOT NULL
  AND dominant_pollutant IS NOT NULL"""))
def q_clean_station_rows(spark, sf_dir):
    return clean.clean_station_rows(readings_dirty(spark, sf_dir).drop("event_id"))


@query("flatten_json", with_views(READINGS, """
SELECT waqi_idx, measured_at, CASE WHEN event_id % 11 = 0 THEN NULL ELSE aqi END AS aqi, dominant_pollutant,
  pm25, pm10, CAST(NULL AS DOUBLE) AS co, CAST(NULL AS DOUBLE) AS no2, CAST(NULL AS DOUBLE) AS o3,
  CAST(NULL AS DOUBLE) AS so2, humidity, temperature, pressure, wind, 'api' AS source,
  '2024-02-01T00:00:00' AS ingested_at, queried_city, 'Station ' || CAST(waqi_idx AS VARCHAR) AS station_name,
  'https://aqi.example/city/vietnam/' || queried_city || '/' AS url,
  CAST(8 + waqi_idx % 16 AS DOUBLE) AS lat, CAST(102 + waqi_idx % 8 AS DOUBLE) AS lon,
  CAST(year(measured_at) AS VARCHAR) AS year, lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month
FROM readings WHERE event_id % 43 <> 0"""))
def q_flatten_json(spark, sf_dir):
    return clean.flatten_reading(api_documents(spark, sf_dir), ingested_at="2024-02-01T00:00:00")


@query("latest_per_key", with_views(READINGS, READINGS_DUP, """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY waqi_idx, measured_at ORDER BY ingested_at DESC, event_id DESC) AS rn
  FROM readings_dup) x WHERE rn = 1"""))
def q_latest_per_key(spark, sf_dir):
    return dedup.latest_per_key(readings_dup(spark, sf_dir), ["waqi_idx", "measured_at"], ["ingested_at"])


@query("upsert_station", with_views(READINGS, STATIONS, """
existing AS (SELECT * FROM stations),
incoming AS (SELECT CASE WHEN waqi_idx % 7 = 0 THEN waqi_idx + 100000000 ELSE waqi_idx END AS waqi_idx, 'Station ' || CAST(waqi_idx AS VARCHAR) AS station_name, queried_city,
                    CAST(8 + waqi_idx % 16 AS DOUBLE) AS lat, CAST(102 + waqi_idx % 8 AS DOUBLE) AS lon
             FROM readings GROUP BY ALL)
SELECT * FROM existing
UNION ALL
SELECT * FROM incoming WHERE waqi_idx NOT IN (SELECT waqi_idx FROM existing)"""))
def q_upsert_station(spark, sf_dir):
    """All stations are there already, but for every seventh one of the readings, which comes under a new number."""
    existing = stations(spark, sf_dir)
    number = F.when(F.expr("data.idx % 7 = 0"), F.col("data.idx") + 100_000_000).otherwise(F.col("data.idx"))
    docs = api_documents(spark, sf_dir).withColumn("data", F.col("data").withField("idx", number.cast("int")))
    flat = clean.flatten_reading(docs, ok_only=False, ingested_at="x")
    incoming = flat.select("waqi_idx", "station_name", "queried_city", "lat", "lon")
    return dedup.upsert_new(existing, incoming, ["waqi_idx"], order_by=["station_name"])


@query("fresh_readings", with_views(READINGS, """
SELECT queried_city, COUNT(*) AS n, MIN(measured_at) AS first_at
FROM readings WHERE measured_at >= TIMESTAMP '2024-01-29 00:00:00' GROUP BY 1"""))
def q_fresh_readings(spark, sf_dir):
    r = clean.drop_stale(readings(spark, sf_dir), now="2024-01-31 00:00:00", hours=48)
    return r.groupBy("queried_city").agg(F.count(F.lit(1)).alias("n"), F.min("measured_at").alias("first_at"))
