"""Source/sink and streaming queries: files are written to the shared checkpoint
folder (``spark.checkpoint.dir``), read back through the library, and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline import schemas
from smogline.plans import q_features, q_gold, q_silver  # noqa: F401  (their oracle texts are reused below)
from smogline.operators import clean, gold
from smogline.operators import windows as W
from smogline.plans.q_gold import DAILY_SUMMARY_SQL
from smogline.plans.registry import ORACLE, query
from smogline.plans.sql_views import READINGS, STATIONS, hourly_cte, with_views, xavg
from smogline.session import scratch_path
from smogline.sources import files
from smogline.sources.testdata import api_documents, readings, readings_dirty, stations
from smogline.streaming import event_time, hourly, ingest

RUN1, RUN2 = "2024-02-01T00:00:00", "2024-02-02T06:00:00"


def _write_docs(docs, path):
    docs.write.mode("append").partitionBy("queried_city", "year", "month", "day").json(path)


def _fact_sql(shift_days: int, ingested_at: str) -> str:
    """Valid API documents as fact rows, their time moved by some days."""
    at = f"measured_at + INTERVAL {shift_days} DAY"
    return f"""SELECT waqi_idx, CAST({at} AS TIMESTAMP) AS measured_at, aqi, dominant_pollutant,
  pm25, pm10, CAST(NULL AS DOUBLE) AS co, CAST(NULL AS DOUBLE) AS no2, CAST(NULL AS DOUBLE) AS o3,
  CAST(NULL AS DOUBLE) AS so2, humidity, temperature, pressure, wind, 'api' AS source, {ingested_at} AS ingested_at,
  queried_city, 'Station ' || CAST(waqi_idx AS VARCHAR) AS station_name,
  'https://aqi.example/city/vietnam/' || queried_city || '/' AS url,
  CAST(8 + waqi_idx % 16 AS DOUBLE) AS lat, CAST(102 + waqi_idx % 8 AS DOUBLE) AS lon,
  CAST(year({at}) AS VARCHAR) AS year, lpad(CAST(month({at}) AS VARCHAR), 2, '0') AS month
FROM readings WHERE event_id % 43 <> 0 AND event_id % 11 <> 0 AND dominant_pollutant IS NOT NULL"""


def _fact_rows(spark, sink):
    return spark.read.schema(ingest.SINK_SCHEMA).parquet(sink).select(
        *clean.FACT_COLUMNS[:16], "queried_city", "station_name", "url", "lat", "lon", "year", "month")


@query("stream_ingest", with_views(READINGS, _fact_sql(0, f"CASE WHEN day(measured_at) <= 15 THEN '{RUN1}' ELSE '{RUN2}' END")))
def q_stream_ingest(spark, sf_dir):
    """Two arrivals of documents (the second re-delivers the first half), three runs; documents without time, aqi or
    pollutant are rejected."""
    root = scratch_path(spark, "stream-ingest")
    src, sink, ckpt = f"{root}/bronze", f"{root}/fact_aqi", f"{root}/_checkpoint"
    docs = api_documents(spark, sf_dir)
    first = docs.filter(F.col("day").cast("int") <= 15)
    _write_docs(first, src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at=RUN1)
    _write_docs(docs.filter(F.col("day").cast("int") > 15).unionByName(first), src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at=RUN2)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="never-used")  # nothing new: no batch runs
    return _fact_rows(spark, sink)


@query("stream_runlog", with_views(READINGS, """
f AS (SELECT event_id % 11 = 0 OR dominant_pollutant IS NULL AS bad, day(measured_at) <= 15 AS early FROM readings WHERE event_id % 43 <> 0)""") + f"""
SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) FILTER (early) AS rows_in, COUNT(*) FILTER (early AND bad) AS rejected,
  CAST(0 AS BIGINT) AS stale, COUNT(*) FILTER (early AND NOT bad) AS new_rows, '{RUN1}' AS ingested_at FROM f
UNION ALL
SELECT 1, COUNT(*), COUNT(*) FILTER (bad), 0, COUNT(*) FILTER (NOT early AND NOT bad), '{RUN2}' FROM f""")
def q_stream_runlog(spark, sf_dir):
    """The log of two runs, of which the second gets the first one's documents again, and of a third without any."""
    root = scratch_path(spark, "stream-runlog")
    src, sink, ckpt = f"{root}/bronze", f"{root}/fact_aqi", f"{root}/_checkpoint"
    docs = api_documents(spark, sf_dir)
    first = docs.filter(F.col("day").cast("int") <= 15)
    _write_docs(first, src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at=RUN1)
    _write_docs(docs, src)
    for run in (RUN2, "never-used"):
        ingest.ingest_new(spark, src, sink, ckpt, ingested_at=run)
    return spark.read.schema("batch_id long, rows_in long, rejected long, stale long, new_rows long, ingested_at string").json(f"{sink}_runlog")


def shifted_documents(docs, days: int):
    """The same documents measured some days later (their bronze folder doesn't matter to the ingest)."""
    later = F.to_timestamp("data.time.iso") + F.make_dt_interval(F.lit(days))
    return docs.withColumn("data", F.col("data").withField("time.iso", F.date_format(later, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")))


@query("stream_ingest_months", with_views(READINGS, _fact_sql(0, f"'{RUN1}'") + "\nUNION ALL\n" + _fact_sql(31, f"'{RUN2}'")))
def q_stream_ingest_months(spark, sf_dir):
    """The second delivery repeats the stored month and brings the first readings of later ones."""
    root = scratch_path(spark, "stream-months")
    src, sink, ckpt = f"{root}/bronze", f"{root}/fact_aqi", f"{root}/_checkpoint"
    docs = api_documents(spark, sf_dir)
    _write_docs(docs, src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at=RUN1)
    _write_docs(docs.unionByName(shifted_documents(docs, 31)), src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at=RUN2)
    return _fact_rows(spark, sink)


@query("stream_hourly", with_views(READINGS, """
f AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE aqi END AS aqi_api FROM readings WHERE event_id % 43 <> 0)""") + f"""
SELECT queried_city, date_trunc('hour', measured_at) AS hour_start, {xavg('aqi_api')} AS aqi, {xavg('pm25')} AS pm25,
  {xavg('pm10')} AS pm10, {xavg('humidity')} AS humidity, {xavg('temperature')} AS temperature, COUNT(*) AS n
FROM f GROUP BY 1, 2""")
def q_stream_hourly(spark, sf_dir):
    """Hourly means kept up as documents arrive, the newest hours included."""
    root = scratch_path(spark, "stream-hourly")
    src = f"{root}/bronze"
    _write_docs(api_documents(spark, sf_dir), src)
    hourly.hourly_stream(spark, src, f"{root}/hourly", f"{root}/_checkpoint")
    return hourly.read_hourly(spark, f"{root}/hourly")


def corrected_documents(docs):
    """A second delivery of every third station's documents: aqi one higher, every other one in the next city."""
    later = docs.filter("pmod(data.idx, 3) = 0").withColumn(
        "data", F.col("data").withField("aqi", (F.col("data.aqi").try_cast("double") + 1).cast("string")))
    return later.withColumn("queried_city", F.when(F.expr("pmod(data.idx, 2) = 0"), F.lit("moved"))
                            .otherwise(F.col("queried_city")))


@query("stream_hourly_redelivered", with_views(READINGS, """
f AS (SELECT * REPLACE (CASE WHEN waqi_idx % 6 = 0 THEN 'moved' ELSE queried_city END AS queried_city),
        CASE WHEN event_id % 11 = 0 THEN NULL WHEN waqi_idx % 3 = 0 THEN aqi + 1 ELSE aqi END AS aqi_api
      FROM readings WHERE event_id % 43 <> 0)""") + f"""
SELECT queried_city, date_trunc('hour', measured_at) AS hour_start, {xavg('aqi_api')} AS aqi, {xavg('pm25')} AS pm25,
  {xavg('pm10')} AS pm10, {xavg('humidity')} AS humidity, {xavg('temperature')} AS temperature, COUNT(*) AS n
FROM f GROUP BY 1, 2""")
def q_stream_hourly_redelivered(spark, sf_dir):
    """Readings delivered again, some corrected and some in another city: each counts once, as last delivered."""
    root = scratch_path(spark, "stream-redelivered")
    src = f"{root}/bronze"
    docs = api_documents(spark, sf_dir)
    _write_docs(docs, src)
    hourly.hourly_stream(spark, src, f"{root}/hourly", f"{root}/_checkpoint")
    _write_docs(docs.filter("pmod(data.idx, 3) <> 0"), src)
    _write_docs(corrected_documents(docs), src)
    hourly.hourly_stream(spark, src, f"{root}/hourly", f"{root}/_checkpoint", max_files=200)
    return hourly.read_hourly(spark, f"{root}/hourly")


@query("stream_late", with_views(READINGS, """
f AS (SELECT * FROM readings WHERE event_id % 43 <> 0 AND event_id % 11 <> 0 AND dominant_pollutant IS NOT NULL)""") + """
SELECT waqi_idx, measured_at, aqi, dominant_pollutant, queried_city, day(measured_at) <= 15 AS late FROM f""")
def q_stream_late(spark, sf_dir):
    """The month's second half first; then the first half, behind the watermark, with the second half again."""
    root = scratch_path(spark, "stream-late")
    src = f"{root}/bronze"
    docs = api_documents(spark, sf_dir)
    _write_docs(docs.filter(F.col("day").cast("int") > 15), src)
    event_time.event_time_stream(spark, src, f"{root}/tables", ingested_at=RUN1)
    _write_docs(docs, src)
    event_time.event_time_stream(spark, src, f"{root}/tables", ingested_at=RUN2)
    return event_time.read_event_time(spark, f"{root}/tables").select(
        "waqi_idx", "measured_at", "aqi", "dominant_pollutant", "queried_city", "late")


_CSV_MAP = {"station_id": "Station ID", "aqi_index": "AQI index", "location": "Location",
            "station_name": "Station name", "url": "Url", "dominent_pollutant": "Dominent pollutant",
            "humidity": "Humidity", "pressure": "Pressure", "pm10": "PM10", "pm25": "PM2.5",
            "temperature": "Temperature", "wind": "Wind", "data_time_s": "Data Time S", "data_time_tz": "Data Time Tz"}


@query("csv_ingest", ORACLE["clean_station_rows"])
def q_csv_ingest(spark, sf_dir):
    """Dirty rows written as a raw station CSV (original headers), read as text, cleaned."""
    path = scratch_path(spark, "station-csv")
    d = readings_dirty(spark, sf_dir).withColumnsRenamed(_CSV_MAP)
    cols = [F.col(f"`{c}`") if c in d.columns else F.lit(None).cast("string").alias(c)
            for c in schemas.STATION_CSV_COLUMNS]
    d.select(*cols).write.option("header", True).csv(path)
    return clean.clean_station_rows(files.read_station_csv(spark, path))


@query("scored_parts", with_views(READINGS, hourly_cte()) + """
SELECT queried_city, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at, aqi AS predicted_aqi
FROM h WHERE hour(measured_at) <> 3""")
def q_scored_parts(spark, sf_dir):
    """Scoring output parts with non-numeric predictions mixed in; only numeric rows kept."""
    path = scratch_path(spark, "scored")
    h = W.hourly(readings(spark, sf_dir))
    out = h.select("queried_city", F.date_format("measured_at", "yyyy-MM-dd HH:mm:ss").alias("measured_at"),
                   F.when(F.hour("measured_at") == 3, F.lit("not-a-number")).otherwise(F.col("aqi").cast("string"))
                   .alias("predicted_aqi"))
    out.write.csv(path)
    return files.read_scored(spark, path, ["queried_city", "measured_at", "predicted_aqi"], "predicted_aqi")


@query("gold_rewrite", DAILY_SUMMARY_SQL)
def q_gold_rewrite(spark, sf_dir):
    """Daily summary written twice with dynamic partition overwrite: the rerun replaces, never appends."""
    path = scratch_path(spark, "gold-daily")
    daily = gold.daily_summary(readings(spark, sf_dir))
    for _ in range(2):
        files.write_table(daily, path, ["year", "month"], mode="overwrite", dynamic=True)
    return spark.read.schema(daily.schema).parquet(path)


@query("run_once_load", with_views(STATIONS) + "\nSELECT * FROM stations")
def q_run_once_load(spark, sf_dir):
    """A one-time load guarded by a flag: the second call is skipped."""
    root = scratch_path(spark, "once")

    def load():
        files.write_table(stations(spark, sf_dir), f"{root}/dim_station", mode="append")

    assert files.run_once(spark, f"{root}/_flag", load)
    assert not files.run_once(spark, f"{root}/_flag", load)
    return spark.read.parquet(f"{root}/dim_station")


@query("gold_records", with_views(READINGS, hourly_cte()) + """
SELECT queried_city, strftime(measured_at, '%Y-%m-%dT%H:%M:%S') AS measured_at, aqi AS predicted_aqi,
  'run-0001' AS run_id, '20240201' AS dt FROM h""")
def q_gold_records(spark, sf_dir):
    """Forecast rows as JSON lines under dt=YYYYMMDD with the run id, read back with a schema."""
    path = scratch_path(spark, "gold-forecast")
    h = W.hourly(readings(spark, sf_dir)).select(
        "queried_city", F.date_format("measured_at", "yyyy-MM-dd'T'HH:mm:ss").alias("measured_at"),
        F.col("aqi").alias("predicted_aqi"))
    files.write_gold_records(h, path, "run-0001", "20240201")
    return spark.read.schema("queried_city string, measured_at string, predicted_aqi double, run_id string, dt string") \
        .json(path)


@query("api_json_batch", ORACLE["flatten_json"])
def q_api_json_batch(spark, sf_dir):
    """API documents written as JSON under queried_city/year/month/day, read in batch."""
    path = scratch_path(spark, "bronze-json")
    _write_docs(api_documents(spark, sf_dir), path)
    return clean.flatten_reading(files.read_api_json(spark, path, multi_line=False), ingested_at=RUN1)


_FEATURE_SQL = ORACLE["feature_table"]


@query("parquet_tree", f"SELECT * EXCLUDE (year, month_part) FROM ({_FEATURE_SQL}) t")
def q_parquet_tree(spark, sf_dir):
    """Feature table written partitioned by year/month, read back as 'all Parquet files under a folder'."""
    path = scratch_path(spark, "features")
    files.write_table(W.hourly_features(W.hourly(readings(spark, sf_dir))), path, ["year", "month_part"])
    return files.read_tree(spark, path)


@query("features_since", f"SELECT * FROM ({_FEATURE_SQL}) t WHERE measured_at >= TIMESTAMP '2024-01-15 00:00:00'")
def q_features_since(spark, sf_dir):
    """Start-date filter on a year/month-partitioned feature table (partition predicate added)."""
    path = scratch_path(spark, "features")
    f = W.hourly_features(W.hourly(readings(spark, sf_dir)))
    files.write_table(f, path, ["year", "month_part"])
    back = spark.read.schema(f.schema).parquet(path)
    return clean.since(back, "2024-01-15 00:00:00", partition_cols=("year", "month_part"))


@query("stream_dedup", ORACLE["flatten_json"])
def q_stream_dedup(spark, sf_dir):
    """Re-delivered identical documents dropped, whatever batch they come in."""
    root = scratch_path(spark, "stream-dedup")
    src = f"{root}/bronze"
    docs = api_documents(spark, sf_dir)
    _write_docs(docs, src)
    _write_docs(docs.filter(F.col("day").cast("int") % 3 == 0), src)  # second delivery of some days
    ingest.dedup_stream(spark, src, f"{root}/fact", f"{root}/_checkpoint", ingested_at=RUN1)
    return _fact_rows(spark, f"{root}/fact")
