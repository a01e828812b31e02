"""Hourly means of a stream that delivers readings again, changed or not.

A reading is the value of a (station, time) key, and the last delivery counts. Two tables are kept, one folder per batch
in each (a retried batch replaces its own, so an interrupted run changes nothing twice):

* ``readings``: the value that each key took in that batch, by day of measurement. A batch reads the stored
  values of its own keys on the days it touches, never the whole history.
* ``hourly``: exact sums per (city, hour) of what the batch changed: the new values added, the replaced ones subtracted.

``read_hourly`` adds up the changes. Of several deliveries of a key the latest file wins (equal files: the greater
values), which is a total order, so the result doesn't depend on how a backlog is cut into batches. A reading without
time counts in a row without hour; a reading that moved to another city leaves the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.functions.columns import exact_mean, scaled
from smogline.operators.clean import flatten_reading
from smogline.sources.files import existing_paths
from smogline.streaming.ingest import KEYS, document_stream, run_available

HOURLY_MEASURES = ("aqi", "pm25", "pm10", "humidity", "temperature")
VALUES = ("delivered_at", "queried_city", *HOURLY_MEASURES)
READINGS = ("waqi_idx int, measured_at timestamp, delivered_at timestamp, queried_city string, "
            + ", ".join(f"{m} double" for m in HOURLY_MEASURES) + ", batch long, day string")


def _stored(spark: SparkSession, sink: str, days: list[str], batch_id: int) -> DataFrame:
    """The values that earlier batches stored on ``days``."""
    paths = existing_paths(spark, [f"{sink}/readings/batch=*/day={d}" for d in days])
    if not paths:
        return spark.createDataFrame([], READINGS)
    rows = spark.read.schema(READINGS).option("basePath", f"{sink}/readings").parquet(*paths)
    return rows.filter(F.col("batch") < batch_id)


def changed_readings(new: DataFrame, stored: DataFrame) -> DataFrame:
    """(keys, now, old): the keys whose value in ``new`` replaces the one in ``stored`` (or is the first). Both may
    hold several values of a key; the greatest counts."""
    keys = new.select(*[F.col(k).alias(f"_{k}") for k in KEYS]).distinct()
    known = stored.join(keys, [stored[k].eqNullSafe(keys[f"_{k}"]) for k in KEYS], "left_semi")
    value = F.struct(*VALUES)
    both = (new.select(*KEYS, value.alias("value"), F.lit(False).alias("there"))
            .unionByName(known.select(*KEYS, value.alias("value"), F.lit(True).alias("there"))))
    best = both.groupBy(*KEYS).agg(F.max(F.struct("value", "there")).alias("best"),
                                   F.max(F.when(F.col("there"), F.col("value"))).alias("old"))
    return best.filter(~F.col("best.there")).select(*KEYS, F.col("best.value").alias("now"), "old")


def hour_changes(changed: DataFrame) -> DataFrame:
    """Sums and counts per (city, hour): the new values added, the old ones subtracted."""
    hour = F.date_trunc("hour", "measured_at").alias("hour_start")
    signed = (changed.select(hour, "now.*", F.lit(1).alias("sign"))
              .unionByName(changed.filter("old IS NOT NULL").select(hour, "old.*", F.lit(-1).alias("sign"))))
    sign = F.col("sign")
    return signed.groupBy("queried_city", "hour_start").agg(
        *[F.sum(scaled(c) * sign).alias(f"sum_{c}") for c in HOURLY_MEASURES],
        *[F.sum(F.when(F.col(c).isNotNull(), sign)).alias(f"n_{c}") for c in HOURLY_MEASURES], F.sum(sign).alias("n"))


def hourly_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, multi_line: bool = False,
                  max_files: int | None = None) -> None:
    """Process the documents that arrived since the last run; see ``read_hourly``."""
    docs = document_stream(spark, source, multi_line, max_files).withColumn(
        "delivered_at", F.col("_metadata.file_modification_time"))

    def add(batch: DataFrame, batch_id: int) -> None:
        flat = flatten_reading(batch, ingested_at="stream", keep=["delivered_at"])
        best = flat.groupBy(*KEYS).agg(F.max(F.struct(*VALUES)).alias("value")).select(*KEYS, "value.*")
        new = best.withColumn("day", F.coalesce(F.date_format("measured_at", "yyyy-MM-dd"), F.lit("none"))).persist()
        try:
            days = [r["day"] for r in new.select("day").distinct().collect()]  # bounded: days
            if days:
                changed = changed_readings(new, _stored(spark, sink, days, batch_id)).persist()
                try:
                    day = F.coalesce(F.date_format("measured_at", "yyyy-MM-dd"), F.lit("none")).alias("day")
                    (changed.select(*KEYS, "now.*", day).write.mode("overwrite").partitionBy("day")
                     .parquet(f"{sink}/readings/batch={batch_id}"))
                    hour_changes(changed).write.mode("overwrite").parquet(f"{sink}/hourly/batch={batch_id}")
                finally:
                    changed.unpersist()
        finally:
            new.unpersist()

    run_available(docs, checkpoint, add)


def read_hourly(spark: SparkSession, sink: str) -> DataFrame:
    """Hourly means per city of the readings as last delivered."""
    parts = spark.read.parquet(f"{sink}/hourly")
    return parts.groupBy("queried_city", "hour_start").agg(
        *[exact_mean(F.sum(f"sum_{c}"), F.sum(f"n_{c}")).alias(c) for c in HOURLY_MEASURES],
        F.sum("n").alias("n")).filter("n > 0")
