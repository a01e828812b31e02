"""Silver-layer cleaning: flatten API documents, clean raw CSV rows, row filters.

Everything is a projection or filter (narrow, codegen); types are decided from the
input schema at plan time, so dirty text never reaches a failing ANSI cast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smogline import constants as K
from smogline.functions.columns import (
    city_from_url, clean_numeric, keyword_category, month_text, null_if_tokens, parse_number,
    split_pair, timestamp_with_offset, year_text,
)

IAQI_FIELDS = {"pm25": "pm25", "pm10": "pm10", "co": "co", "no2": "no2", "o3": "o3", "so2": "so2",
               "h": "humidity", "t": "temperature", "p": "pressure", "w": "wind"}

FACT_COLUMNS = ["waqi_idx", "measured_at", "aqi", "dominant_pollutant", "pm25", "pm10", "co", "no2", "o3",
                "so2", "humidity", "temperature", "pressure", "wind", "source", "ingested_at",
                "queried_city", "year", "month"]


def _field_type(schema: StructType, path: str):
    t = schema
    for part in path.split("."):
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return None
        t = t[part].dataType
    return t


def _numeric_at(df: DataFrame, path: str) -> Column:
    """Double at a nested path; absent path or unparsable value -> null double."""
    t = _field_type(df.schema, path)
    if t is None:
        return F.lit(None).cast("double")
    return clean_numeric(F.col(path), t)


def flatten_reading(docs: DataFrame, source: str = "api", ingested_at: str | None = None,
                    ok_only: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """API document (``status``, ``data`` struct, path columns) -> one fact row of scalars (and the ``keep`` columns)."""
    d = docs.filter(F.col("status") == "ok") if ok_only and "status" in docs.columns else docs
    measures = [_numeric_at(d, f"data.iaqi.{k}.v").alias(v) for k, v in IAQI_FIELDS.items()]
    ts = F.try_to_timestamp(F.col("data.time.iso"))
    out = d.select(
        F.col("data.idx").cast("int").alias("waqi_idx"),
        ts.alias("measured_at"),
        _numeric_at(d, "data.aqi").alias("aqi"),
        F.nullif(F.col("data.dominentpol"), F.lit("")).alias("dominant_pollutant"),
        *measures,
        F.lit(source).alias("source"),
        (F.lit(ingested_at) if ingested_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
         ).alias("ingested_at"),
        F.col("queried_city"),
        F.col("data.city.name").alias("station_name"),
        F.col("data.city.url").alias("url"),
        F.get(F.col("data.city.geo"), 0).cast("double").alias("lat"),
        F.get(F.col("data.city.geo"), 1).cast("double").alias("lon"),
        *keep,
    )
    return out.withColumn("year", year_text("measured_at")).withColumn("month", month_text("measured_at"))


# --- fixed values: raw CSV header -> column name -----------------------------
CSV_RENAMES = {
    "Station ID": "station_id", "AQI index": "aqi_index", "Location": "location",
    "Station name": "station_name", "Url": "url", "Dominent pollutant": "dominent_pollutant",
    "CO": "co", "Dew": "dew", "Humidity": "humidity", "NO2": "no2", "O3": "o3", "Pressure": "pressure",
    "PM10": "pm10", "PM2.5": "pm25", "SO2": "so2", "Temperature": "temperature", "Wind": "wind",
    "Data Time S": "data_time_s", "Data Time Tz": "data_time_tz", "Status": "status", "Alert level": "alert_level",
}


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = CSV_RENAMES) -> DataFrame:
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


#: A reading without one of these is not stored.
REQUIRED = ("measured_at", "aqi", "dominant_pollutant")


def clean_station_rows(raw: DataFrame, keywords: Mapping[str, Sequence[str]] = K.CITY_KEYWORDS_ETL,
                       case_insensitive: bool = False, source: str = "kaggle",
                       ingested_at: str = "2024-02-01T00:00:00") -> DataFrame:
    """Raw station-history text rows -> fact rows (plus name/url/lat/lon).

    Junk tokens to null, thousands separators removed, offset-aware time parsed,
    'lat,lon' split, invalid pollutant category nulled, city from the station name
    (rows of other cities dropped), and rows missing station/time/aqi/pollutant dropped.
    """
    r = rename_columns(raw)
    numeric = [c for c in ["co", "no2", "o3", "so2", "pm25", "pm10", "humidity", "temperature", "pressure", "wind"]]
    pollutant = null_if_tokens("dominent_pollutant")
    city = keyword_category("station_name", keywords, case_insensitive=case_insensitive)
    out = r.select(
        F.col("station_id").try_cast("int").alias("waqi_idx"),
        timestamp_with_offset("data_time_s", "data_time_tz").alias("measured_at"),
        parse_number("aqi_index").alias("aqi"),
        F.when(pollutant.isin(*K.INVALID_POLLUTANTS), F.lit(None).cast("string")).otherwise(pollutant)
        .alias("dominant_pollutant"),
        *[(parse_number(c) if c in r.columns else F.lit(None).cast("double")).alias(c) for c in numeric],
        F.lit(source).alias("source"),
        F.lit(ingested_at).alias("ingested_at"),
        city.alias("queried_city"),
        F.col("station_name"),
        F.col("url"),
        split_pair("location", 0).alias("lat"),
        split_pair("location", 1).alias("lon"),
    )
    out = out.filter(F.col("queried_city").isNotNull())
    out = required(out, ["waqi_idx", *REQUIRED])
    return out.withColumn("year", year_text("measured_at")).withColumn("month", month_text("measured_at"))


def required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is null."""
    return df.na.drop(subset=list(cols))


def drop_stale(df: DataFrame, now: dt.datetime | str, hours: int = 48, ts: str = "measured_at") -> DataFrame:
    """Keep rows measured at or after ``now - hours``; ``now`` is an argument, so reruns repeat."""
    cutoff = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.filter(F.col(ts) >= cutoff)


def since(df: DataFrame, start: dt.datetime | str, ts: str = "measured_at",
          partition_cols: tuple[str, str] | None = ("year", "month")) -> DataFrame:
    """Start-date filter; when the table is partitioned by year/month text, a matching
    partition predicate is added so the scan prunes directories too."""
    start_ts = F.lit(start).cast("timestamp")
    out = df.filter(F.col(ts) >= start_ts)
    if partition_cols and all(c in df.columns for c in partition_cols):
        y, m = partition_cols
        out = out.filter(F.concat(F.col(y), F.col(m)) >= F.concat(year_text(start_ts), month_text(start_ts)))
    return out


def in_cities(df: DataFrame, cities: Sequence[str], col: str = "queried_city") -> DataFrame:
    return df.filter(F.col(col).isin(list(cities)))


def in_box(df: DataFrame, lat: tuple[float, float] = (8, 24), lon: tuple[float, float] = (102, 110)) -> DataFrame:
    return df.filter(F.col("lat").between(*lat) & F.col("lon").between(*lon))


def with_city_from_url(df: DataFrame, url: str = "url", drop_unknown: bool = True) -> DataFrame:
    out = df.withColumn("queried_city", city_from_url(url))
    return out.filter(F.col("queried_city") != "unknown") if drop_unknown else out
