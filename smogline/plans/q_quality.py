"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline import constants as K
from smogline.operators import quality
from smogline.plans.registry import query
from smogline.plans.sql_views import READINGS, READINGS_DUP, STATIONS, with_views
from smogline.sources.testdata import readings_dup, stations

NOW = "2024-02-03 00:00:00"

def metrics_cte(src: str = "readings_dup", now: str = NOW) -> str:
    return f"""
qm AS (SELECT COUNT(*) AS total_rows,
        CAST(COUNT_IF(aqi IS NULL) AS BIGINT) AS null_aqi, CAST(COUNT_IF(measured_at IS NULL) AS BIGINT) AS null_measured_at,
        CAST(COUNT_IF(dominant_pollutant IS NULL) AS BIGINT) AS null_dominant_pollutant,
        CAST(COUNT_IF(queried_city IS NULL) AS BIGINT) AS null_queried_city,
        CAST(COUNT_IF(aqi < 0 OR aqi > 500) AS BIGINT) AS aqi_out_of_range,
        list_sort(list_distinct(list(queried_city))) AS cities,
        list_sort(list_distinct(list(CASE WHEN source NOT IN ('kaggle', 'api') THEN source END))) AS invalid_sources,
        CAST(COUNT_IF(TRY_CAST(ingested_at AS TIMESTAMP) >= TIMESTAMP '{now}' - INTERVAL 48 HOUR) AS BIGINT) AS fresh_rows
      FROM {src}),
mt AS (SELECT *, array_to_string(cities, ',') AS distinct_cities,
         array_to_string(invalid_sources, ',') AS invalid_source_list FROM qm)"""


_METRICS_SQL = metrics_cte()


@query("dq_metrics", with_views(READINGS, READINGS_DUP, _METRICS_SQL) + "\nSELECT * FROM mt")
def q_dq_metrics(spark, sf_dir):
    return quality.fact_metrics(readings_dup(spark, sf_dir), NOW)


def _pct(c):
    return f"CASE WHEN total_rows > 0 THEN round(null_{c} / total_rows * 100 + 1e-9, 2) ELSE 0.0 END"


_EXP = "['cao-bang', 'da-nang', 'gia-lai', 'ha-noi', 'ho-chi-minh-city']"
_MISS_F = f"list_filter({_EXP}, lambda x: NOT list_contains(qm.cities, x))"
_MISS_D = f"list_filter({_EXP}, lambda x: NOT list_contains(dm.cities, x))"

def checks_cte(dim: str = "stations") -> str:
    """CTEs dm (dimension metrics) and chk (the eleven check rows); needs ``metrics_cte`` first."""
    return f"""
dm AS (SELECT COUNT(*) AS total_stations, list_sort(list_distinct(list(queried_city))) AS cities FROM {dim}),
chk AS (
SELECT 'row_count' AS "check", 'fact_aqi' AS "table", CAST(NULL AS VARCHAR) AS "column", CAST(total_rows AS DOUBLE) AS value,
  CAST(10.0 AS DOUBLE) AS threshold, total_rows >= 10 AS passed, 'fact_aqi row count: ' || total_rows || ' (min: 10)' AS message FROM qm
""" + "".join(f"""UNION ALL
SELECT 'null_pct', 'fact_aqi', '{c}', {_pct(c)}, 5.0, {_pct(c)} <= 5.0,
  'fact_aqi.{c} null%: ' || CAST({_pct(c)} AS VARCHAR) || '% (max: 5.0%)' FROM qm
""" for c in ["aqi", "measured_at", "dominant_pollutant", "queried_city"]) + f"""UNION ALL
SELECT 'aqi_range', 'fact_aqi', 'aqi', aqi_out_of_range, 0.0, aqi_out_of_range = 0,
  'AQI out of range [0-500]: ' || aqi_out_of_range || ' records' FROM qm
UNION ALL
SELECT 'city_coverage', 'fact_aqi', 'queried_city', len({_MISS_F}), 0.0, len({_MISS_F}) = 0,
  CASE WHEN len({_MISS_F}) = 0 THEN 'All cities present' ELSE 'Missing cities: ' || array_to_string({_MISS_F}, ',') END FROM qm
UNION ALL
SELECT 'source_validity', 'fact_aqi', 'source', len(invalid_sources), 0.0, len(invalid_sources) = 0,
  CASE WHEN len(invalid_sources) = 0 THEN 'All sources valid'
       ELSE 'Invalid sources: ' || array_to_string(invalid_sources, ',') END FROM qm
UNION ALL
SELECT 'freshness', 'fact_aqi', 'ingested_at', fresh_rows, 1.0, fresh_rows > 0,
  fresh_rows || ' rows ingested in the freshness window' FROM qm
UNION ALL
SELECT 'dim_station_row_count', 'dim_station', NULL, total_stations, 1.0, total_stations > 0,
  'dim_station: ' || total_stations || ' stations' FROM dm
UNION ALL
SELECT 'dim_station_city_coverage', 'dim_station', 'queried_city', len({_MISS_D}), 0.0, len({_MISS_D}) = 0,
  CASE WHEN len({_MISS_D}) = 0 THEN 'All cities have stations'
       ELSE 'Stations missing for cities: ' || array_to_string({_MISS_D}, ',') END FROM dm)"""


_CHECKS_SQL = with_views(READINGS, READINGS_DUP, STATIONS, _METRICS_SQL, checks_cte()) + "\nSELECT * FROM chk"


@query("dq_checks", _CHECKS_SQL)
def q_dq_checks(spark, sf_dir):
    return quality.run_checks(readings_dup(spark, sf_dir), stations(spark, sf_dir), NOW)


BAD_READINGS = """
bad_readings AS (SELECT * REPLACE (
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 900.0 ELSE aqi END AS aqi,
    CASE WHEN event_id % 12 = 0 THEN NULL ELSE measured_at END AS measured_at,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE dominant_pollutant END AS dominant_pollutant,
    CASE WHEN event_id % 15 = 0 THEN NULL ELSE queried_city END AS queried_city,
    CASE WHEN event_id % 7 = 0 THEN 'manual' ELSE source END AS source,
    '2024-01-01T00:00:00' AS ingested_at)
  FROM readings_dup WHERE queried_city <> 'cao-bang'),
bad_stations AS (SELECT * FROM stations WHERE queried_city <> 'gia-lai')"""


def _bad_readings(spark, sf_dir):
    r, n = readings_dup(spark, sf_dir).filter("queried_city <> 'cao-bang'"), F.col("event_id")
    return r.withColumns({
        "aqi": F.when(n % 10 == 0, None).when(n % 101 == 0, 900.0).otherwise(F.col("aqi")),
        "measured_at": F.when(n % 12 != 0, F.col("measured_at")),
        "dominant_pollutant": F.when(n % 3 != 0, F.col("dominant_pollutant")),
        "queried_city": F.when(n % 15 != 0, F.col("queried_city")),
        "source": F.when(n % 7 == 0, "manual").otherwise(F.col("source")),
        "ingested_at": F.lit("2024-01-01T00:00:00")})


@query("dq_checks_failing", with_views(READINGS, READINGS_DUP, STATIONS, BAD_READINGS, metrics_cte("bad_readings"),
                                       checks_cte("bad_stations")) + "\nSELECT * FROM chk")
def q_dq_checks_failing(spark, sf_dir):
    """The checks on a table that breaks all of them but the row counts."""
    return quality.run_checks(_bad_readings(spark, sf_dir), stations(spark, sf_dir).filter("queried_city <> 'gia-lai'"), NOW)


def _value_rows_sql(column: str, expected) -> str:
    known = ", ".join(f"('{v}')" for v in expected)
    return (f"SELECT '{column}' AS \"column\", coalesce(k.v, g.v) AS value, coalesce(n, 0) AS n, CASE WHEN k.v IS NULL THEN 'unexpected' "
            f"WHEN n IS NULL THEN 'missing' ELSE 'present' END AS status FROM (SELECT {column} AS v, COUNT(*) AS n FROM bad_readings "
            f"WHERE {column} IS NOT NULL GROUP BY 1) g FULL JOIN (VALUES {known}) k(v) ON k.v = g.v")


@query("dq_value_rows", with_views(READINGS, READINGS_DUP, STATIONS, BAD_READINGS) + "\n"
       + _value_rows_sql("queried_city", K.EXPECTED_CITIES) + "\nUNION ALL\n" + _value_rows_sql("source", K.VALID_SOURCES))
def q_dq_value_rows(spark, sf_dir):
    """Cities and sources of the failing table, a row each: present, missing or unexpected."""
    bad = _bad_readings(spark, sf_dir)
    return quality.value_rows(bad, "queried_city", K.EXPECTED_CITIES).unionByName(quality.value_rows(bad, "source", K.VALID_SOURCES))


@query("dq_gate", "WITH c AS (" + _CHECKS_SQL + """)
SELECT bool_and(passed) AS quality_passed, CAST(COUNT_IF(passed) AS BIGINT) AS checks_passed, COUNT(*) AS checks_total,
  coalesce(array_to_string(list_sort(list(CASE WHEN NOT passed THEN "check" || '.' || coalesce("column", '') END)), ','), '') AS failed
FROM c""")
def q_dq_gate(spark, sf_dir):
    return quality.summarize(quality.run_checks(readings_dup(spark, sf_dir), stations(spark, sf_dir), NOW))
