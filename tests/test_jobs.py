"""End-to-end jobs: CSV history load once, API ingest, gate, gold build, features."""

import datetime as dt

import duckdb
import pyspark.sql.functions as F

from smogline import schemas
from smogline.plans import jobs, q_gold
from smogline.plans.registry import ORACLE
from smogline.plans.q_stream import _CSV_MAP
from smogline.session import scratch_path
from smogline.sources.testdata import api_documents, readings_dirty
from tests.conftest import SF_SMALL
from tests.oracle import canon, rows_of_spark, rows_of_sql


def test_silver_gold_features(spark):
    root = scratch_path(spark, "t-jobs")
    csv = f"{root}/raw_csv"
    d = readings_dirty(spark, SF_SMALL).withColumnsRenamed(_CSV_MAP)
    d.select(*[F.col(f"`{c}`") if c in d.columns else F.lit(None).cast("string").alias(c)
               for c in schemas.STATION_CSV_COLUMNS]).write.option("header", True).csv(csv)
    silver = f"{root}/silver"
    assert jobs.silver_from_csv(spark, csv, silver, "2024-02-01T00:00:00")
    assert not jobs.silver_from_csv(spark, csv, silver, "2024-02-01T00:00:00")  # flag: runs once
    n_csv = jobs.read_fact(spark, silver).count()
    api_documents(spark, SF_SMALL).write.partitionBy("queried_city", "year", "month", "day").json(f"{root}/bronze")
    jobs.silver_from_api(spark, f"{root}/bronze", silver, "2024-02-02T00:00:00")
    fact = jobs.read_fact(spark, silver)
    assert fact.count() > n_csv
    assert fact.groupBy("waqi_idx", "measured_at").count().filter("count > 1").count() == 0
    dim = jobs.read_dimension(spark, f"{silver}/dim_station")
    assert dim.groupBy("waqi_idx").count().filter("count > 1").count() == 0
    checks = jobs.gold_build(spark, fact, dim, f"{root}/gold", now="2024-02-03 00:00:00")
    assert checks.count() == 11
    if checks.agg(F.bool_and("passed")).first()[0]:
        daily = spark.read.parquet(f"{root}/gold/gold_aqi_daily_summary")
        assert daily.count() > 0
        assert daily.select("_aggregated_at").distinct().count() == 1
    jobs.features_build(spark, fact, f"{root}/features")
    assert spark.read.parquet(f"{root}/features").count() > 0


def test_gate_blocks_gold_writes(spark):
    root = scratch_path(spark, "t-gate")
    fact = spark.createDataFrame([(1, None, 600.0, None, "x", "2020-01-01T00:00:00", "ha-noi")],
                                 "waqi_idx int, measured_at timestamp, aqi double, dominant_pollutant string, "
                                 "source string, ingested_at string, queried_city string")
    dim = spark.createDataFrame([], "waqi_idx int, queried_city string")
    checks = jobs.gold_build(spark, fact, dim, f"{root}/gold", now="2024-01-01 00:00:00")
    assert checks.filter(~F.col("passed")).count() > 0
    from smogline.sources.files import path_exists

    assert not path_exists(spark, f"{root}/gold/gold_aqi_daily_summary")


def test_stamps_of_a_job_that_the_gate_blocks_equal_the_sql(spark):
    """One value off the scale: the job writes nothing, its daily query is empty, the stamps are those of the SQL."""
    root = scratch_path(spark, "t-stamps")
    types = ["click", "view", "purchase", "signup", "error"]
    events = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i), i % 9, types[i % 5], 700.0 if i == 3 else 10.0 + i, '{"k": %d}' % i)
              for i in range(200)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(i, f"Customer {i}") for i in range(9)], "c_custkey long, c_name string") \
        .write.parquet(f"{root}/customer.parquet")
    assert q_gold.q_gold_job_daily(spark, root).count() == 0
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root.removeprefix('file:')}/{t}.parquet/*.parquet')")
    cols, got = rows_of_spark(q_gold.q_gold_job_stamps(spark, root))
    assert len(got) == 3 and canon(got) == canon(rows_of_sql(con, ORACLE["gold_job_stamps"], cols))
