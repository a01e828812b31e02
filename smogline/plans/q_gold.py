"""Gold-layer queries over the readings/stations adapter views."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline.functions.columns import aqi_level
from smogline.operators import gold
from smogline.plans.registry import query
from smogline.plans.sql_views import READINGS, STATIONS, level, ravg, with_views
from smogline.sources.testdata import readings, stations

def daily_ctes(src: str = "readings") -> str:
    """CTEs d, m, a, daily: the gold daily summary over the fact view ``src``."""
    return f"""
d AS (SELECT *, CAST(measured_at AS DATE) AS "date" FROM {src}),
m AS (SELECT queried_city, "date", dominant_pollutant FROM (
        SELECT queried_city, "date", dominant_pollutant,
               ROW_NUMBER() OVER (PARTITION BY queried_city, "date"
                                  ORDER BY COUNT(*) DESC, dominant_pollutant ASC NULLS LAST) AS rn
        FROM d GROUP BY queried_city, "date", dominant_pollutant) x WHERE rn = 1),
a AS (SELECT queried_city, "date", {ravg('aqi')} AS avg_aqi, MAX(aqi) AS max_aqi, MIN(aqi) AS min_aqi,
        {ravg('pm25')} AS avg_pm25, {ravg('pm10')} AS avg_pm10, {ravg('humidity')} AS avg_humidity,
        {ravg('temperature')} AS avg_temperature, COUNT(DISTINCT waqi_idx) AS station_count,
        COUNT(*) AS record_count
      FROM d GROUP BY queried_city, "date"),
daily AS (SELECT a.*, m.dominant_pollutant, {level('max_aqi')} AS pollution_level,
        CAST(year("date") AS VARCHAR) AS year, lpad(CAST(month("date") AS VARCHAR), 2, '0') AS month
      FROM a LEFT JOIN m USING (queried_city, "date"))"""


_DAILY_SQL = with_views(READINGS, daily_ctes("readings"))

DAILY_SUMMARY_SQL = _DAILY_SQL + "\nSELECT * FROM daily"


@query("daily_summary", DAILY_SUMMARY_SQL)
def q_daily_summary(spark, sf_dir):
    return gold.daily_summary(readings(spark, sf_dir))


@query("dominant_pollutant", with_views(READINGS, """
c AS (SELECT queried_city, CAST(measured_at AS DATE) AS "date", dominant_pollutant, COUNT(*) AS n
      FROM readings GROUP BY ALL)
SELECT queried_city, "date", dominant_pollutant FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY queried_city, "date"
                               ORDER BY n DESC, dominant_pollutant ASC NULLS LAST) AS rn FROM c) x
WHERE rn = 1"""))
def q_dominant_pollutant(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("date", F.to_date("measured_at"))
    return gold.grouped_mode(r, ["queried_city", "date"], "dominant_pollutant")


def monthly_ctes(src: str = "readings") -> str:
    """CTEs of the monthly ranking (after ``daily_ctes``) plus its final SELECT."""
    return f""",
mm AS (SELECT queried_city, year, month, dominant_pollutant FROM (
        SELECT queried_city, CAST(year(measured_at) AS VARCHAR) AS year,
               lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month, dominant_pollutant,
               ROW_NUMBER() OVER (PARTITION BY queried_city, CAST(year(measured_at) AS VARCHAR),
                                  lpad(CAST(month(measured_at) AS VARCHAR), 2, '0')
                                  ORDER BY COUNT(*) DESC, dominant_pollutant ASC NULLS LAST) AS rn
        FROM {src} GROUP BY 1, 2, 3, 4) x WHERE rn = 1),
mo AS (SELECT queried_city, year, month, {ravg('avg_aqi')} AS avg_aqi, MAX(max_aqi) AS max_aqi,
        MIN(min_aqi) AS min_aqi, {ravg('avg_pm25')} AS avg_pm25, {ravg('avg_pm10')} AS avg_pm10,
        CAST(SUM(record_count) AS BIGINT) AS record_count,
        CAST(COUNT_IF(pollution_level = 'Good') AS BIGINT) AS days_good,
        CAST(COUNT_IF(pollution_level = 'Moderate') AS BIGINT) AS days_moderate,
        CAST(COUNT_IF(pollution_level = 'Unhealthy for Sensitive Groups') AS BIGINT) AS days_sensitive,
        CAST(COUNT_IF(pollution_level = 'Unhealthy') AS BIGINT) AS days_unhealthy,
        CAST(COUNT_IF(pollution_level = 'Very Unhealthy') AS BIGINT) AS days_very_unhealthy,
        CAST(COUNT_IF(pollution_level = 'Hazardous') AS BIGINT) AS days_hazardous
      FROM daily GROUP BY queried_city, year, month)
SELECT mo.*, mm.dominant_pollutant, {level('avg_aqi')} AS pollution_level,
  CAST(DENSE_RANK() OVER (PARTITION BY year, month ORDER BY avg_aqi DESC) AS INTEGER) AS aqi_rank,
  CAST(DENSE_RANK() OVER (PARTITION BY year, month ORDER BY avg_pm25 DESC) AS INTEGER) AS pm25_rank
FROM mo LEFT JOIN mm USING (queried_city, year, month)"""


_MONTHLY_SQL = _DAILY_SQL + monthly_ctes("readings")


@query("city_ranking", _MONTHLY_SQL)
def q_city_ranking(spark, sf_dir):
    return gold.monthly_ranking(readings(spark, sf_dir))


@query("station_summary", with_views(READINGS, STATIONS, f"""
f AS (SELECT waqi_idx, queried_city, CAST(year(measured_at) AS VARCHAR) AS year,
        lpad(CAST(month(measured_at) AS VARCHAR), 2, '0') AS month,
        aqi, pm25, pm10, humidity, temperature, dominant_pollutant FROM readings),
md AS (SELECT waqi_idx, year, month, dominant_pollutant FROM (
        SELECT waqi_idx, year, month, dominant_pollutant,
               ROW_NUMBER() OVER (PARTITION BY waqi_idx, year, month
                                  ORDER BY COUNT(*) DESC, dominant_pollutant ASC NULLS LAST) AS rn
        FROM f GROUP BY 1, 2, 3, 4) x WHERE rn = 1),
s AS (SELECT f.waqi_idx, st.station_name, f.queried_city, st.lat, st.lon, f.year, f.month,
        {ravg('aqi')} AS avg_aqi, MAX(aqi) AS max_aqi, MIN(aqi) AS min_aqi,
        {ravg('pm25')} AS avg_pm25, {ravg('pm10')} AS avg_pm10, {ravg('humidity')} AS avg_humidity,
        {ravg('temperature')} AS avg_temperature, COUNT(*) AS record_count
      FROM f LEFT JOIN stations st ON f.waqi_idx = st.waqi_idx
      GROUP BY f.waqi_idx, st.station_name, f.queried_city, st.lat, st.lon, f.year, f.month)
SELECT s.*, md.dominant_pollutant, {level('avg_aqi')} AS pollution_level,
  CAST(DENSE_RANK() OVER (PARTITION BY queried_city, year, month ORDER BY avg_aqi DESC) AS INTEGER) AS rank_in_city
FROM s LEFT JOIN md USING (waqi_idx, year, month)"""))
def q_station_summary(spark, sf_dir):
    return gold.station_summary(readings(spark, sf_dir), stations(spark, sf_dir))


@query("aqi_level", with_views(READINGS, f"""
SELECT {level('aqi')} AS pollution_level, COUNT(*) AS n, MIN(aqi) AS min_aqi, MAX(aqi) AS max_aqi
FROM readings GROUP BY 1"""))
def q_aqi_level(spark, sf_dir):
    r = readings(spark, sf_dir)
    return r.groupBy(aqi_level("aqi").alias("pollution_level")).agg(
        F.count(F.lit(1)).alias("n"), F.min("aqi").alias("min_aqi"), F.max("aqi").alias("max_aqi"))


GOLD_NOW = "2024-02-02 00:00:00"


def _gold_job_sql() -> str:
    from smogline.plans.q_quality import checks_cte, metrics_cte

    return with_views(READINGS, STATIONS, """
fj AS (SELECT *, '2024-02-01T00:00:00' AS ingested_at FROM readings)""", metrics_cte("fj", "2024-02-02 00:00:00"),
                      checks_cte("stations"), daily_ctes("fj")) + """
SELECT * FROM daily WHERE (SELECT bool_and(passed) FROM chk)"""


def _gold_job(spark, sf_dir):
    """The gated gold job: (folder of its tables, the fact table it was run on)."""
    from smogline.plans import jobs
    from smogline.session import scratch_path

    path = scratch_path(spark, "gold-job")
    fact = readings(spark, sf_dir).withColumn("ingested_at", F.lit("2024-02-01T00:00:00"))
    jobs.gold_build(spark, fact, stations(spark, sf_dir), path, now=GOLD_NOW)
    return path, fact


@query("gold_job_daily", _gold_job_sql())
def q_gold_job_daily(spark, sf_dir):
    """The gated gold job end to end: when every check passes the tables are written and
    the daily table is read back; when a check fails nothing is written (empty result)."""
    from smogline.sources.files import path_exists

    path, fact = _gold_job(spark, sf_dir)
    schema = gold.daily_summary(fact).schema
    if not path_exists(spark, f"{path}/gold_aqi_daily_summary"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/gold_aqi_daily_summary")


@query("gold_job_stamps", with_views(READINGS, STATIONS) + """
SELECT 'gold_aqi_daily_summary' AS name, TIMESTAMP '2024-02-02 00:00:00' AS aggregated_at,
  COUNT(DISTINCT (queried_city, CAST(measured_at AS DATE))) AS n FROM readings
UNION ALL
SELECT 'gold_aqi_city_ranking', TIMESTAMP '2024-02-02 00:00:00', COUNT(DISTINCT (queried_city, date_trunc('month', measured_at))) FROM readings
UNION ALL
SELECT 'gold_station_summary', TIMESTAMP '2024-02-02 00:00:00', COUNT(DISTINCT (waqi_idx, queried_city, date_trunc('month', measured_at))) FROM readings""")
def q_gold_job_stamps(spark, sf_dir):
    """Every row of the gold job's three tables carries the time of its run. The stamps are asked for whatever the checks
    say: when the gate wrote nothing, the job's tables are written to a folder of their own."""
    from smogline.plans import jobs
    from smogline.session import scratch_path
    from smogline.sources.files import path_exists

    path, fact = _gold_job(spark, sf_dir)
    tables = ["gold_aqi_daily_summary", "gold_aqi_city_ranking", "gold_station_summary"]
    if not path_exists(spark, f"{path}/{tables[0]}"):
        path = scratch_path(spark, "gold-stamps")
        jobs.gold_tables(spark, fact, stations(spark, sf_dir), path, now=GOLD_NOW)
    stamps = [spark.read.schema("_aggregated_at timestamp").parquet(f"{path}/{t}").groupBy(F.col("_aggregated_at").alias("aggregated_at")).agg(F.count(F.lit(1)).alias("n"))
              .select(F.lit(t).alias("name"), "aggregated_at", "n") for t in tables]
    return stamps[0].unionByName(stamps[1]).unionByName(stamps[2])
