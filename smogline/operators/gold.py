"""Gold summaries: daily city summary, monthly ranking, monthly station summary.

All are hash aggregations with map-side partial aggregation, so a hot city or
day is reduced inside each map task before the shuffle. The category mode is its
own small table: counts per (group, category) - a codegen hash aggregate reading
three narrow columns - reduced to the best category per group, then joined to the
group statistics (AQE broadcasts it, it has one row per group). Null counts as a
category; ties go alphabetical, nulls last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.operators.dedup import assert_unique
from smogline.functions.columns import aqi_level, month_text, null_last_key, rounded_avg, year_text

def grouped_mode(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """Most frequent ``value`` per group (null included; ties -> smallest text, null last)."""
    keys = list(keys)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct(
        (-F.col("_n")).alias("n"), null_last_key(value).alias("k"), F.col(value).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(alias or value))


def level_counts(level: str | Column, labels: Sequence[str], names: Sequence[str]) -> list[Column]:
    lv = F.col(level) if isinstance(level, str) else level
    return [F.count_if(lv == F.lit(lab)).alias(n) for lab, n in zip(labels, names)]


def daily_summary(fact: DataFrame, digits: int = 2) -> DataFrame:
    """Per (queried_city, date): rounded means, extremes, stations, rows, mode, level on max."""
    d = fact.withColumn("date", F.to_date("measured_at"))
    daily = d.groupBy("queried_city", "date").agg(
        rounded_avg("aqi", digits).alias("avg_aqi"),
        F.max("aqi").alias("max_aqi"),
        F.min("aqi").alias("min_aqi"),
        rounded_avg("pm25", digits).alias("avg_pm25"),
        rounded_avg("pm10", digits).alias("avg_pm10"),
        rounded_avg("humidity", digits).alias("avg_humidity"),
        rounded_avg("temperature", digits).alias("avg_temperature"),
        F.count_distinct("waqi_idx").alias("station_count"),
        F.count(F.lit(1)).alias("record_count"),
    )
    daily = daily.join(grouped_mode(d, ["queried_city", "date"], "dominant_pollutant"), ["queried_city", "date"], "left")
    return daily.select(
        "*",
        aqi_level("max_aqi").alias("pollution_level"),
        year_text("date").alias("year"),
        month_text("date").alias("month"),
    )


LEVEL_LABELS = ["Good", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous"]
LEVEL_DAY_COLUMNS = ["days_good", "days_moderate", "days_sensitive", "days_unhealthy",
                     "days_very_unhealthy", "days_hazardous"]


def monthly_ranking(fact: DataFrame, daily: DataFrame | None = None, digits: int = 2) -> DataFrame:
    """Monthly city table rolled up from the daily one, with level-day counts and ranks.

    The rank window partitions by (year, month) over one row per city: tiny input.
    """
    daily = daily if daily is not None else daily_summary(fact, digits)
    monthly = daily.groupBy("queried_city", "year", "month").agg(
        rounded_avg("avg_aqi", digits).alias("avg_aqi"),
        F.max("max_aqi").alias("max_aqi"),
        F.min("min_aqi").alias("min_aqi"),
        rounded_avg("avg_pm25", digits).alias("avg_pm25"),
        rounded_avg("avg_pm10", digits).alias("avg_pm10"),
        F.sum("record_count").alias("record_count"),
        *level_counts("pollution_level", LEVEL_LABELS, LEVEL_DAY_COLUMNS),
    )
    mode = grouped_mode(
        fact.select("queried_city", year_text("measured_at").alias("year"),
                    month_text("measured_at").alias("month"), "dominant_pollutant"),
        ["queried_city", "year", "month"], "dominant_pollutant")
    w_aqi = Window.partitionBy("year", "month").orderBy(F.col("avg_aqi").desc())
    w_pm = Window.partitionBy("year", "month").orderBy(F.col("avg_pm25").desc())
    return (
        monthly.join(mode, ["queried_city", "year", "month"], "left")
        .withColumn("pollution_level", aqi_level("avg_aqi"))
        .withColumn("aqi_rank", F.dense_rank().over(w_aqi))
        .withColumn("pm25_rank", F.dense_rank().over(w_pm))
    )


def station_summary(fact: DataFrame, dim: DataFrame, digits: int = 2, check_unique: bool = True) -> DataFrame:
    """Monthly per-station summary with names/coordinates and rank within city.

    The fact is aggregated to (station, city, month) first and only then joined to
    the dimension, so the join sees stations x months rows instead of readings.
    The planner chooses the join from the sizes it sees.
    """
    f = fact.select("waqi_idx", "queried_city", year_text("measured_at").alias("year"),
                    month_text("measured_at").alias("month"),
                    "aqi", "pm25", "pm10", "humidity", "temperature", "dominant_pollutant")
    agg = f.groupBy("waqi_idx", "queried_city", "year", "month").agg(
        rounded_avg("aqi", digits).alias("avg_aqi"),
        F.max("aqi").alias("max_aqi"),
        F.min("aqi").alias("min_aqi"),
        rounded_avg("pm25", digits).alias("avg_pm25"),
        rounded_avg("pm10", digits).alias("avg_pm10"),
        rounded_avg("humidity", digits).alias("avg_humidity"),
        rounded_avg("temperature", digits).alias("avg_temperature"),
        F.count(F.lit(1)).alias("record_count"),
    )
    # the pollutant mode is keyed by (station, month) only, as in the gold job
    mode = grouped_mode(f, ["waqi_idx", "year", "month"], "dominant_pollutant")
    agg = agg.join(mode, ["waqi_idx", "year", "month"], "left")
    d = dim.select("waqi_idx", "station_name", "lat", "lon")
    if check_unique:  # a repeated key would fan the summary out
        assert_unique(d, ["waqi_idx"])
    joined = agg.join(d, "waqi_idx", "left")
    w = Window.partitionBy("queried_city", "year", "month").orderBy(F.col("avg_aqi").desc())
    return joined.withColumn("pollution_level", aqi_level("avg_aqi")).withColumn(
        "rank_in_city", F.dense_rank().over(w))
