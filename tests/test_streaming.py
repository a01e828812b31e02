"""Incremental ingest: new files only, no duplicate keys, run log per batch."""

import pyspark.sql.functions as F

from smogline.plans.q_stream import shifted_documents
from smogline.session import scratch_path
from smogline.sources.testdata import api_documents
from smogline.operators import windows as W
from smogline.operators.clean import flatten_reading
from smogline.operators.dedup import latest_per_key, new_keys, new_keys_in_place
from smogline.streaming import event_time, hourly, ingest
from tests.conftest import SF_SMALL


def test_ingest_twice_adds_nothing_and_logs(spark):
    root = scratch_path(spark, "t-ingest")
    src, sink, ckpt = f"{root}/bronze", f"{root}/fact", f"{root}/_ckpt"
    docs = api_documents(spark, SF_SMALL)
    docs.write.partitionBy("queried_city", "year", "month", "day").json(src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="2024-02-01T00:00:00")
    first = spark.read.schema(ingest.SINK_SCHEMA).parquet(sink).count()
    # the same documents delivered again as new files: keys already present are skipped
    docs.write.mode("append").partitionBy("queried_city", "year", "month", "day").json(src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="2024-02-02T00:00:00")
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="2024-02-03T00:00:00")
    fact = spark.read.schema(ingest.SINK_SCHEMA).parquet(sink)
    assert fact.count() == first
    assert fact.select("waqi_idx", "measured_at").distinct().count() == first
    ok_docs = docs.filter(F.col("status") == "ok").count()
    rejected = docs.filter("status = 'ok' AND (data.aqi = '-' OR data.dominentpol IS NULL)").count()
    assert first == ok_docs - rejected and rejected > 0
    log = spark.read.json(sink + "_runlog").orderBy("batch_id").collect()
    assert [(r.new_rows, r.rows_in, r.rejected, r.stale) for r in log] == [(first, ok_docs, rejected, 0), (0, ok_docs, rejected, 0)]
    assert fact.filter("aqi IS NULL OR dominant_pollutant IS NULL OR measured_at IS NULL").count() == 0


def test_redelivery_with_a_new_month_duplicates_nothing(spark):
    root = scratch_path(spark, "t-months")
    src, sink, ckpt = f"{root}/bronze", f"{root}/fact", f"{root}/_ckpt"
    docs = api_documents(spark, SF_SMALL)
    docs.write.partitionBy("queried_city", "year", "month", "day").json(src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="2024-02-01T00:00:00")
    january = spark.read.schema(ingest.SINK_SCHEMA).parquet(sink).count()
    docs.unionByName(shifted_documents(docs, 31)).write.mode("append").partitionBy(
        "queried_city", "year", "month", "day").json(src)
    ingest.ingest_new(spark, src, sink, ckpt, ingested_at="2024-03-01T00:00:00")
    fact = spark.read.schema(ingest.SINK_SCHEMA).parquet(sink)
    assert fact.count() == 2 * january == fact.select("waqi_idx", "measured_at").distinct().count()


def test_stale_readings_are_counted_not_stored(spark):
    root = scratch_path(spark, "t-stale")
    src, sink = f"{root}/bronze", f"{root}/fact"
    api_documents(spark, SF_SMALL).write.partitionBy("queried_city", "year", "month", "day").json(src)
    ingest.ingest_new(spark, src, sink, f"{root}/_ckpt", ingested_at="x", now="2024-01-16 00:00:00")
    fact = spark.read.schema(ingest.SINK_SCHEMA).parquet(sink)
    log = spark.read.json(sink + "_runlog").first()
    assert fact.agg(F.min("measured_at")).first()[0].isoformat() >= "2024-01-14T00:00:00"
    assert log.stale > 0 and log.new_rows == fact.count() == log.rows_in - log.rejected - log.stale


def test_streams_do_not_depend_on_the_batches(spark):
    root = scratch_path(spark, "t-batches")
    src = f"{root}/bronze"
    docs = api_documents(spark, SF_SMALL)
    docs.coalesce(1).write.partitionBy("queried_city").json(src)
    docs.filter("pmod(data.idx, 3) = 0").coalesce(1).write.mode("append").partitionBy("queried_city").json(src)
    rows = []
    for files in (None, 3):
        out = f"{root}/{files}"
        hourly.hourly_stream(spark, src, f"{out}/hourly", f"{out}/_h", max_files=files)
        ingest.dedup_stream(spark, src, f"{out}/fact", f"{out}/_d", ingested_at="x", max_files=files)
        ingest.ingest_new(spark, src, f"{out}/new", f"{out}/_n", ingested_at="x", max_files=files)
        rows.append([sorted(map(str, hourly.read_hourly(spark, f"{out}/hourly").collect())),
                     *[sorted(map(str, spark.read.schema(ingest.SINK_SCHEMA).parquet(f"{out}/{t}").select(
                         "waqi_idx", "measured_at", "aqi", "queried_city").collect())) for t in ("fact", "new")]])
    assert rows[0] == rows[1] and all(rows[0])


def test_interrupted_dimension_upsert_keeps_every_station(spark, monkeypatch):
    path = f"{scratch_path(spark, 't-dim')}/dim"
    rows = [(i, f"S{i}", "ha-noi", 1.0, 2.0, "u", "api") for i in range(6)]
    names = "waqi_idx int, station_name string, queried_city string, lat double, lon double, url string, source string"
    incoming = spark.createDataFrame(rows, names)
    ingest.upsert_stations(spark, incoming.filter("waqi_idx < 4"), path)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("pyspark.sql.DataFrameWriter.parquet", broken)
        try:
            ingest.upsert_stations(spark, incoming, path)
        except RuntimeError:
            pass
    assert spark.read.parquet(path).count() == 4
    for _ in range(2):
        ingest.upsert_stations(spark, incoming.union(incoming), path)
    assert sorted(r.waqi_idx for r in spark.read.parquet(path).collect()) == list(range(6))


def test_streams_rerun_add_nothing(spark):
    root = scratch_path(spark, "t-wm")
    src = f"{root}/bronze"
    docs = api_documents(spark, SF_SMALL)
    docs.write.partitionBy("queried_city", "year", "month", "day").json(src)
    docs.filter(F.col("day").cast("int") % 2 == 0).write.mode("append").partitionBy(
        "queried_city", "year", "month", "day").json(src)  # re-delivered copies
    for _ in range(2):
        hourly.hourly_stream(spark, src, f"{root}/hourly", f"{root}/_ck_hourly")
        ingest.dedup_stream(spark, src, f"{root}/fact", f"{root}/_ck_fact", ingested_at="2024-02-01T00:00:00")
    means = hourly.read_hourly(spark, f"{root}/hourly")
    assert means.groupBy("queried_city", "hour_start").count().filter("count > 1").count() == 0
    fact = spark.read.schema(ingest.SINK_SCHEMA).parquet(f"{root}/fact")
    assert fact.count() == docs.filter(F.col("status") == "ok").count()
    assert fact.select("waqi_idx", "measured_at").distinct().count() == fact.count()


def _timeless(docs):
    return docs.filter("pmod(data.idx, 4) = 0").withColumn("data", F.col("data").withField("time.iso", F.lit(None).cast("string")))


def test_hourly_means_of_redelivered_readings_equal_the_batch(spark):
    """One delivery, then changed, moved, time-less and identical ones; as one batch each, as a few and as one a file."""
    root = scratch_path(spark, "t-redelivered")
    src = f"{root}/bronze"
    docs = api_documents(spark, SF_SMALL)
    moved = docs.filter("pmod(data.idx, 6) = 0").withColumn("queried_city", F.lit("moved"))
    deliveries = [docs.unionByName(_timeless(docs)), docs, _timeless(docs), moved]
    write = lambda d: d.coalesce(1).write.mode("append").partitionBy("queried_city").json(src)
    write(deliveries[0])
    tables = {files: f"{root}/{files}" for files in (None, 6, 1)}
    for files, out in tables.items():
        hourly.hourly_stream(spark, src, f"{out}/hourly", f"{out}/_h", max_files=files)
    for d in deliveries[1:]:
        write(d)
    got = []
    for files, out in tables.items():
        hourly.hourly_stream(spark, src, f"{out}/hourly", f"{out}/_h", max_files=files)
        got.append(sorted(map(str, hourly.read_hourly(spark, f"{out}/hourly").collect())))
    last = flatten_reading(docs, ingested_at="x").withColumn(
        "queried_city", F.when(F.expr("pmod(waqi_idx, 6) = 0"), F.lit("moved")).otherwise(F.col("queried_city")))
    timed = [r for r in got[0] if "hour_start=None" not in r]
    want = last.groupBy("queried_city", F.date_trunc("hour", "measured_at").alias("hour_start")).agg(
        *[W.exact_avg(c).alias(c) for c in hourly.HOURLY_MEASURES], F.count(F.lit(1)).alias("n"))
    assert timed == sorted(map(str, want.collect())) and len(timed) < len(got[0])
    assert got[0] == got[1] == got[2]
    stations = flatten_reading(_timeless(docs), ingested_at="x").select("waqi_idx").distinct().count()
    assert hourly.read_hourly(spark, f"{tables[1]}/hourly").filter("hour_start IS NULL").agg(F.sum("n")).first()[0] == stations


def test_a_retried_hourly_batch_counts_once(spark):
    root = scratch_path(spark, "t-retry")
    docs = api_documents(spark, SF_SMALL)
    docs.coalesce(2).write.partitionBy("queried_city").json(f"{root}/src")
    hourly.hourly_stream(spark, f"{root}/src", f"{root}/out", f"{root}/_a")
    once = sorted(map(str, hourly.read_hourly(spark, f"{root}/out").collect()))
    hourly.hourly_stream(spark, f"{root}/src", f"{root}/out", f"{root}/_b")  # as after a lost checkpoint: batch 0 again
    assert sorted(map(str, hourly.read_hourly(spark, f"{root}/out").collect())) == once


def test_main_and_late_hold_every_reading_once(spark):
    root = scratch_path(spark, "t-late")
    src = f"{root}/bronze"
    docs = api_documents(spark, SF_SMALL)
    day = F.col("day").cast("int")
    write = lambda d: d.coalesce(1).write.mode("append").partitionBy("queried_city").json(src)
    out = {files: f"{root}/{files}" for files in (None, 2)}
    for part in (docs.filter(day > 20), docs.filter(day > 10).unionByName(_timeless(docs)), docs, docs.filter(day < 5)):
        write(part)
        for files, tables in out.items():
            event_time.event_time_stream(spark, src, tables, ingested_at="x", max_files=files)
    flat = flatten_reading(docs, ingested_at="x").filter("measured_at IS NOT NULL AND aqi IS NOT NULL AND dominant_pollutant IS NOT NULL")
    want = sorted(map(str, flat.select("waqi_idx", "measured_at", "aqi").collect()))
    for files, tables in out.items():
        rows = event_time.read_event_time(spark, tables)
        assert sorted(map(str, rows.select("waqi_idx", "measured_at", "aqi").collect())) == want
        assert {r["late"] for r in rows.collect()} == {True, False}
        assert spark.read.parquet(f"{tables}/rejected").filter("measured_at IS NULL").count() > 0


def test_readings_without_time_are_stored_once(spark):
    root = scratch_path(spark, "t-timeless")
    src = f"{root}/bronze"
    docs = _timeless(api_documents(spark, SF_SMALL))
    counts = []
    for _ in range(3):
        docs.write.mode("append").partitionBy("queried_city").json(src)
        ingest.dedup_stream(spark, src, f"{root}/fact", f"{root}/_d", ingested_at="x")
        counts.append(spark.read.schema(ingest.SINK_SCHEMA).parquet(f"{root}/fact").count())
    assert counts[0] > 0 and counts == counts[:1] * 3


def test_batches_come_flat_and_known_rows_stay_where_they_lie(spark, monkeypatch):
    """The stream hands no nested document to a batch; the anti-join shuffles the stored keys only, null parts included."""
    root = scratch_path(spark, "t-flat")
    api_documents(spark, SF_SMALL).coalesce(1).write.partitionBy("queried_city").json(f"{root}/src")
    seen = []
    monkeypatch.setattr(ingest, "_upsert_batch", lambda spark, batch, *args: seen.append(batch.columns))
    ingest.ingest_new(spark, f"{root}/src", f"{root}/fact", f"{root}/_c", ingested_at="x")
    assert seen and not {"data", *ingest.ADDED} & set(seen[0]) and {"aqi", "url", *ingest.KEYS} <= set(seen[0])

    ids = [None, *range(40)]
    rows = spark.createDataFrame([(i, j, f"{i}-{j}-{c}") for i in ids for j in (None, 1, 2) for c in "ab"], "a int, b int, v string")
    stored = spark.createDataFrame([(i, j) for i in ids[:20] for j in (None, 1)] * 2, "a int, b int")
    fresh = latest_per_key(rows, ["a", "b"], []).persist()
    try:
        assert fresh.count() == 41 * 3
        got = new_keys_in_place(fresh, stored, ["a", "b"])
        assert sorted(map(str, got.collect())) == sorted(map(str, new_keys(fresh, stored, ["a", "b"]).collect()))
        assert got.count() == 41 * 3 - 40
        plan = got._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1].split("InMemoryTableScan")[0]
        assert "Exchange" not in plan and "Sort " not in plan
    finally:
        fresh.unpersist()
