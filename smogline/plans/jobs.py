"""End-to-end jobs composed from the operators (silver, quality gate, gold, features).

Each job takes paths in the shared file system and is idempotent: silver appends
only new keys, gold and features rewrite the partitions they produce (dynamic
overwrite), and a failed quality gate stops the gold build before anything is written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline import schemas
from smogline.operators import clean, dedup, gold, quality
from smogline.operators import windows as W
from smogline.sources import files
from smogline.streaming import ingest


def silver_from_api(spark: SparkSession, bronze: str, silver: str, ingested_at: str,
                    now: dt.datetime | str | None = None, stale_hours: int = 48) -> None:
    """New API documents -> fact_aqi (incremental, deduplicated against the table)."""
    ingest.ingest_new(spark, bronze, f"{silver}/fact_aqi", f"{silver}/_checkpoints/fact_aqi", ingested_at,
                      now=now, stale_hours=stale_hours, stations=f"{silver}/dim_station")


def silver_from_csv(spark: SparkSession, csv_path: str, silver: str, ingested_at: str) -> bool:
    """One-time historical load of the station CSV (guarded by a flag)."""

    def load() -> None:
        rows = clean.clean_station_rows(files.read_station_csv(spark, csv_path), ingested_at=ingested_at)
        rows = dedup.latest_per_key(rows, ["waqi_idx", "measured_at"], ["ingested_at"])
        files.write_table(rows.select(*[f.name for f in ingest.SINK_SCHEMA.fields]), f"{silver}/fact_aqi",
                          ["queried_city", "year", "month"])
        ingest.upsert_stations(spark, rows.select("waqi_idx", "station_name", "queried_city", "lat", "lon", "url",
                                           F.lit("kaggle").alias("source")), f"{silver}/dim_station")

    return files.run_once(spark, f"{silver}/_flags/csv_loaded", load)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DIM_STATION).parquet(path)


def read_fact(spark: SparkSession, silver: str) -> DataFrame:
    """The silver fact table, checked against its schema at the layer boundary."""
    fact = spark.read.schema(ingest.SINK_SCHEMA).parquet(f"{silver}/fact_aqi")
    return schemas.assert_schema(fact, schemas.FACT_AQI)


def gold_build(spark: SparkSession, fact: DataFrame, dim: DataFrame, gold_path: str,
               now: dt.datetime | str) -> DataFrame:
    """Quality gate, then the gold tables. Returns the check table; nothing is written when a check fails."""
    checks = quality.run_checks(fact, dim, now)
    if quality.gate(checks):
        gold_tables(spark, fact, dim, gold_path, now)
    return checks


def gold_tables(spark: SparkSession, fact: DataFrame, dim: DataFrame, gold_path: str, now: dt.datetime | str) -> None:
    """Daily summary, monthly ranking and station summary, every row stamped with ``now``.

    The daily table feeds the monthly one, so it is written first and the monthly roll-up reads the
    written partitions instead of recomputing them.
    """
    daily = gold.daily_summary(fact)

    def stamped(df: DataFrame) -> DataFrame:
        return df.withColumn("_aggregated_at", F.lit(now).cast("timestamp"))

    files.write_table(stamped(daily), f"{gold_path}/gold_aqi_daily_summary", ["year", "month"], mode="overwrite",
                      dynamic=True)
    daily_back = spark.read.schema(daily.schema).parquet(f"{gold_path}/gold_aqi_daily_summary")
    files.write_table(stamped(gold.monthly_ranking(fact, daily_back)), f"{gold_path}/gold_aqi_city_ranking",
                      mode="overwrite")
    files.write_table(stamped(gold.station_summary(fact, dim)), f"{gold_path}/gold_station_summary", ["year", "month"],
                      mode="overwrite", dynamic=True)


def features_build(spark: SparkSession, fact: DataFrame, path: str, grid: bool = False) -> None:
    """Hourly ML feature table, partitioned by city/year/month (dynamic overwrite)."""
    h = W.hourly(fact)
    feats = W.grid_features(h) if grid else W.hourly_features(h)
    files.write_table(feats, path, ["queried_city", "year", "month_part"], mode="overwrite", dynamic=True)
