"""Incremental ingest with Structured Streaming.

Every stream is a file stream of API documents with ``trigger(availableNow=True)``, so each run processes only
files not seen before (the checkpoint is the bookmark), and a ``foreachBatch`` whose effect does not depend on how
a backlog is cut into batches (``max_files`` bounds a batch):

* ``ingest_new``: flatten, required fields, optional staleness filter, dedup within the batch, and anti-join against
  the months of the target that the batch touches, so retries and re-delivered readings never duplicate a
  (station, time) key; new stations go to the dimension; a run-log row counts what came, was rejected, was new.
* ``dedup_stream``: like ``ingest_new`` without the required fields.

See ``hourly`` for hourly means and ``event_time`` for deduplication under a watermark.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from smogline import schemas
from smogline.functions.columns import month_text, year_text
from smogline.operators.clean import REQUIRED, drop_stale, flatten_reading
from smogline.operators.dedup import latest_per_key, new_keys, new_keys_in_place
from smogline.sources.files import existing_paths, observed_counts

KEYS = ["waqi_idx", "measured_at"]
#: Folder name of a null partition value (readings without time).
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Equal in a whole batch or given by the key: they decide between no copies, so only the rows that are stored get them.
ADDED = ["source", "ingested_at", "year", "month"]

# the silver table written by ``ingest_new`` (partition columns stay text on read)
SINK_SCHEMA = StructType(schemas.FACT_AQI.fields + [
    StructField("station_name", StringType()), StructField("url", StringType()),
    StructField("lat", DoubleType()), StructField("lon", DoubleType())])


def document_stream(spark: SparkSession, path: str, multi_line: bool = False, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schemas.API_DOCUMENT_WITH_PATH).option("multiLine", multi_line)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def reading_stream(spark: SparkSession, path: str, ingested_at: str, multi_line: bool = False,
                   max_files: int | None = None) -> DataFrame:
    """The documents as flat rows without ``ADDED``: flattened by the stream itself, so only the fields in use are parsed and
    no nested document is handed to the batch."""
    return flatten_reading(document_stream(spark, path, multi_line, max_files), ingested_at=ingested_at).drop(*ADDED)


def _append_new(spark: SparkSession, rows: DataFrame, sink: str, name: str, ingested_at: str):
    """Append the rows (cached, one per key) whose key is in none of the months of ``sink`` that they touch; the count of
    appended rows, or None for an empty batch."""
    year, month = year_text("measured_at").alias("year"), month_text("measured_at").alias("month")
    months = [tuple(r) for r in rows.select(year, month).distinct().collect()]  # bounded: months
    if not months:
        return None
    # only folders that exist are read: a month's first readings find none, the others are still compared
    paths = existing_paths(spark, [f"{sink}/queried_city=*/year={y or NO_VALUE}/month={m or NO_VALUE}" for y, m in months])
    if paths:
        stored = spark.read.schema(SINK_SCHEMA).option("basePath", sink).parquet(*paths)
        rows = new_keys_in_place(rows, stored, KEYS)
    rows = rows.withColumns({"source": F.lit("api"), "ingested_at": F.lit(ingested_at)}).select("*", year, month)
    rows, written = observed_counts(rows.select(*[f.name for f in SINK_SCHEMA.fields]), name)
    rows.write.mode("append").partitionBy("queried_city", "year", "month").parquet(sink)
    return int(written.get.get("rows", 0))


def upsert_stations(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Append the stations that the dimension does not hold yet (the first name of each). Nothing is ever rewritten,
    so an interrupted run loses no station and a repeated one adds none."""
    names = [f.name for f in schemas.DIM_STATION.fields]
    rows = latest_per_key(incoming.select(*names), ["waqi_idx"], ["station_name"])
    if existing_paths(spark, [path]):
        rows = new_keys(rows, spark.read.schema(schemas.DIM_STATION).parquet(path), ["waqi_idx"])
    rows.write.mode("append").parquet(path)


def _upsert_batch(spark: SparkSession, batch: DataFrame, batch_id: int, sink: str, ingested_at: str,
                  now: dt.datetime | str | None, stale_hours: int, stations: str | None) -> None:
    complete = F.lit(True)
    for c in REQUIRED:
        complete = complete & F.col(c).isNotNull()
    flat, seen = observed_counts(batch, f"ingest-batch-{batch_id}", rejected=~complete)
    valid, kept = observed_counts(flat.filter(complete), f"ingest-valid-{batch_id}")
    if now is not None:
        valid = drop_stale(valid, now, stale_hours)
    valid, current = observed_counts(valid, f"ingest-current-{batch_id}")
    # the batch's files are parsed once: the deduplicated batch is cached for the
    # partition list, the anti-join and the writes
    fresh = latest_per_key(valid, KEYS, []).persist()
    try:
        new_rows = _append_new(spark, fresh, sink, f"ingest-new-{batch_id}", ingested_at)
        if stations and new_rows is not None:
            upsert_stations(spark, fresh.withColumn("source", F.lit("api")), stations)
    finally:
        fresh.unpersist()
    got_in = seen.get  # filled by the actions above
    if not got_in.get("rows"):
        return
    log = spark.createDataFrame(
        [(batch_id, int(got_in["rows"]), int(got_in["rejected"]), int(kept.get["rows"]) - int(current.get["rows"]),
          new_rows or 0, ingested_at)],
        "batch_id long, rows_in long, rejected long, stale long, new_rows long, ingested_at string")
    log.coalesce(1).write.mode("append").json(sink.rstrip("/") + "_runlog")


def run_available(stream: DataFrame, checkpoint: str, each) -> None:
    (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
     .trigger(availableNow=True).start().awaitTermination())


def ingest_new(spark: SparkSession, source: str, sink: str, checkpoint: str, ingested_at: str,
               now: dt.datetime | str | None = None, stale_hours: int = 48, multi_line: bool = False,
               max_files: int | None = None, stations: str | None = None) -> None:
    """Process the documents that arrived since the last run; blocks until done. ``stations`` is the dimension table
    that new stations are appended to."""
    run_available(reading_stream(spark, source, ingested_at, multi_line, max_files), checkpoint,
         lambda b, i: _upsert_batch(spark, b, i, sink, ingested_at, now, stale_hours, stations))


def dedup_stream(spark: SparkSession, source: str, sink: str, checkpoint: str, ingested_at: str,
                 multi_line: bool = False, max_files: int | None = None) -> None:
    """Readings deduplicated by (station, time) against the batch and the table, appended as they arrive; of the readings
    of a station without time, one is kept."""

    def add(batch: DataFrame, batch_id: int) -> None:
        fresh = latest_per_key(batch, KEYS, []).persist()
        try:
            _append_new(spark, fresh, sink, f"dedup-{batch_id}", ingested_at)
        finally:
            fresh.unpersist()

    run_available(reading_stream(spark, source, ingested_at, multi_line, max_files), checkpoint, add)
