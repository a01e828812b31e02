"""Adapter views over the driver's Parquet tables.

The platform's own inputs (API documents, station CSV exports) are not part of
the test data, so the readings fact and the station dimension are derived from
``events`` and ``customer`` with pure projections (no shuffle, pushdown intact).
The same definitions exist as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.session import configure

CITY_CODE_BY_EVENT = {"click": 0, "view": 1, "purchase": 2, "signup": 3}  # others -> 4
CITY_BY_CODE = ["ha-noi", "ho-chi-minh-city", "da-nang", "gia-lai", "cao-bang"]

# ingested_at text of the base load and of the re-delivered copies
BASE_INGESTED_AT = "2024-02-01T00:00:00"
LATE_INGESTED_AT = "2024-02-02T06:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _city_of(code: F.Column) -> F.Column:
    expr = F.when(code == 0, F.lit(CITY_BY_CODE[0]))
    for i in range(1, 4):
        expr = expr.when(code == i, F.lit(CITY_BY_CODE[i]))
    return expr.otherwise(F.lit(CITY_BY_CODE[4]))


def _event_code(event_type: F.Column) -> F.Column:
    expr = None
    for name, code in CITY_CODE_BY_EVENT.items():
        expr = F.when(event_type == name, F.lit(code)) if expr is None else expr.when(event_type == name, F.lit(code))
    return expr.otherwise(F.lit(4))


def readings(spark: SparkSession, sf_dir: str, keep_event_id: bool = True) -> DataFrame:
    """``fact_aqi``-shaped readings (one row per event)."""
    e = table(spark, sf_dir, "events")
    c = _event_code(F.col("event_type"))
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    eid = F.col("event_id")
    cols = [
        (F.col("user_id") * 5 + c).cast("int").alias("waqi_idx"),
        F.col("ts").cast("timestamp").alias("measured_at"),
        _city_of(c).alias("queried_city"),
        F.col("value").alias("aqi"),
        F.when(eid % 29 == 0, F.lit(None).cast("string"))
        .when(eid % 5 < 3, F.lit("pm25"))
        .when(eid % 5 == 3, F.lit("pm10"))
        .otherwise(F.lit("o3")).alias("dominant_pollutant"),
        (F.col("value") * F.lit(0.7)).alias("pm25"),
        F.when(eid % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("value") * F.lit(0.9)).alias("pm10"),
        (F.lit(40) + k % 50).cast("double").alias("humidity"),
        (F.lit(15) + k % 20).cast("double").alias("temperature"),
        (F.lit(1000) + k % 30).cast("double").alias("pressure"),
        (k % 10).cast("double").alias("wind"),
        F.when(eid % 2 == 0, F.lit("kaggle")).otherwise(F.lit("api")).alias("source"),
    ]
    if keep_event_id:
        cols.append(eid.alias("event_id"))
    return e.select(*cols)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dim_station``: one station per (customer, city code); key unique.

    The five-code expansion is a narrow ``explode`` of a literal array, not a join.
    """
    cu = table(spark, sf_dir, "customer")
    c = F.col("c")
    return (
        cu.select("c_custkey", "c_name", F.explode(F.array(*[F.lit(i) for i in range(5)])).alias("c"))
        .select(
            (F.col("c_custkey") * 5 + c).cast("int").alias("waqi_idx"),
            F.concat(F.col("c_name"), F.lit("-"), c.cast("string")).alias("station_name"),
            _city_of(c).alias("queried_city"),
            (F.lit(8) + F.col("c_custkey") % 16).cast("double").alias("lat"),
            (F.lit(102) + F.col("c_custkey") % 8).cast("double").alias("lon"),
        )
    )


def readings_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings plus a re-delivered copy of every 17th event (aqi + 1, ingested later)."""
    base = readings(spark, sf_dir).withColumn("ingested_at", F.lit(BASE_INGESTED_AT))
    again = (
        base.filter(F.col("event_id") % 17 == 0)
        .withColumn("aqi", F.col("aqi") + F.lit(1.0))
        .withColumn("ingested_at", F.lit(LATE_INGESTED_AT))
    )
    return base.unionByName(again)


# --- fixed values: spellings used to build messy station names -------------
NAME_SPELLINGS = [
    ["Hanoi", "Hà Nội", "Ha Noi"],
    ["Ho Chi Minh", "Hồ Chí Minh", "ho chi minh"],
    ["Da Nang", "Đà Nẵng", "da nang"],
    ["Gia Lai", "Pleiku", "gia lai"],
    ["Cao Bằng", "Cao Bang", "cao bang"],
]
URL_SLUGS = ["hanoi", "ho-chi-minh-city", "da-nang", "gia-lai", "cao-bang"]


def readings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-CSV-like text rows (all strings) with the junk the cleaning operators handle."""
    r = readings(spark, sf_dir)
    eid = F.col("event_id")
    code = (F.col("waqi_idx") % 5)
    spellings = F.array(*[F.lit(n) for names in NAME_SPELLINGS for n in names])
    spelling = F.element_at(spellings, (code * 3 + eid % 3 + 1).cast("int"))
    slug = F.element_at(F.array(*[F.lit(x) for x in URL_SLUGS]), (code + 1).cast("int"))
    p = F.col("pressure").cast("int").cast("string")
    local = F.date_format(F.col("measured_at") + F.expr("INTERVAL 7 HOURS"), "yyyy-MM-dd HH:mm:ss")
    return r.select(
        "event_id",
        F.col("waqi_idx").cast("string").alias("station_id"),
        F.when(eid % 11 == 0, F.lit("-")).otherwise(F.col("aqi").cast("string")).alias("aqi_index"),
        F.when(eid % 37 == 0, F.lit("-")).otherwise(
            F.concat((F.lit(8) + F.col("waqi_idx") % 16).cast("string"), F.lit(","),
                     (F.lit(102) + F.col("waqi_idx") % 8).cast("string"))).alias("location"),
        F.concat(spelling, F.lit(" station "), F.col("waqi_idx").cast("string")).alias("station_name"),
        F.when(eid % 31 == 0, F.lit("https://aqi.example/feed/unknown"))
        .otherwise(F.concat(F.lit("https://aqi.example/city/vietnam/"), slug, F.lit("/station-"),
                            F.col("waqi_idx").cast("string"), F.lit("/"))).alias("url"),
        F.when(eid % 23 == 0, F.lit("#NAME?")).when(eid % 19 == 0, F.lit("aqi"))
        .otherwise(F.coalesce(F.col("dominant_pollutant"), F.lit("-"))).alias("dominent_pollutant"),
        F.when(eid % 7 == 0, F.lit("N/A")).otherwise(F.col("humidity").cast("string")).alias("humidity"),
        F.concat(F.substring(p, 1, 1), F.lit(","), F.substring(p, 2, 3)).alias("pressure"),
        F.when(eid % 13 == 0, F.lit("")).otherwise(F.col("pm10").cast("string")).alias("pm10"),
        F.col("pm25").cast("string").alias("pm25"),
        F.col("temperature").cast("string").alias("temperature"),
        F.col("wind").cast("string").alias("wind"),
        F.when(eid % 41 == 0, F.lit("not a time")).otherwise(local).alias("data_time_s"),
        F.lit("+07:00").alias("data_time_tz"),
    )


def api_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested API documents (one per reading) with the path columns of the bronze layout.

    ``aqi`` is text, as the API returns ints or '-'; absent measures are null structs.
    """
    r = readings(spark, sf_dir)
    eid = F.col("event_id")

    def measure(c: str) -> F.Column:
        return F.when(F.col(c).isNull(), F.lit(None)).otherwise(F.struct(F.col(c).alias("v")))

    return r.select(
        F.col("queried_city"),
        F.year("measured_at").cast("string").alias("year"),
        F.lpad(F.month("measured_at").cast("string"), 2, "0").alias("month"),
        F.lpad(F.dayofmonth("measured_at").cast("string"), 2, "0").alias("day"),
        F.struct(
            F.when(eid % 43 == 0, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
            F.struct(
                F.when(eid % 11 == 0, F.lit("-")).otherwise(F.col("aqi").cast("string")).alias("aqi"),
                F.col("waqi_idx").alias("idx"),
                F.col("dominant_pollutant").alias("dominentpol"),
                F.struct(
                    F.concat(F.lit("Station "), F.col("waqi_idx").cast("string")).alias("name"),
                    F.concat(F.lit("https://aqi.example/city/vietnam/"), F.col("queried_city"), F.lit("/")).alias("url"),
                    F.array((F.lit(8) + F.col("waqi_idx") % 16).cast("double"),
                            (F.lit(102) + F.col("waqi_idx") % 8).cast("double")).alias("geo"),
                ).alias("city"),
                F.struct(F.date_format("measured_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("iso")).alias("time"),
                F.struct(
                    measure("pm25").alias("pm25"), measure("pm10").alias("pm10"),
                    F.lit(None).cast("struct<v:double>").alias("co"),
                    F.lit(None).cast("struct<v:double>").alias("no2"),
                    F.lit(None).cast("struct<v:double>").alias("o3"),
                    F.lit(None).cast("struct<v:double>").alias("so2"),
                    F.struct(F.col("humidity").alias("v")).alias("h"),
                    F.struct(F.col("temperature").alias("v")).alias("t"),
                    F.struct(F.col("pressure").alias("v")).alias("p"),
                    F.struct(F.col("wind").alias("v")).alias("w"),
                ).alias("iaqi"),
            ).alias("data"),
        ).alias("doc"),
    ).select("doc.status", "doc.data", "queried_city", "year", "month", "day")


PRIORITY_CODES = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}  # others -> 4
STATUS_POLLUTANT = {"F": "pm25", "O": "pm10"}  # others -> o3


def yearly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year daily readings from ``orders`` (1995-2001), for monthly/annual queries.

    city by order priority, aqi = total price / 1000 (inside the 0-500 scale),
    pollutant by order status; one reading per order at the order date.
    """
    o = table(spark, sf_dir, "orders")
    code = None
    for name, i in PRIORITY_CODES.items():
        cond = F.col("o_orderpriority") == name
        code = F.when(cond, F.lit(i)) if code is None else code.when(cond, F.lit(i))
    code = code.otherwise(F.lit(4))
    pol = F.when(F.col("o_orderstatus") == "F", F.lit("pm25")).when(F.col("o_orderstatus") == "O", F.lit("pm10")) \
        .otherwise(F.lit("o3"))
    aqi = F.col("o_totalprice") / F.lit(1000.0)
    return o.select(
        (F.col("o_custkey") * 5 + code).cast("int").alias("waqi_idx"),
        F.col("o_orderdate").cast("timestamp").alias("measured_at"),
        _city_of(code).alias("queried_city"),
        aqi.alias("aqi"),
        pol.alias("dominant_pollutant"),
        (aqi * F.lit(0.7)).alias("pm25"),
        (aqi * F.lit(0.9)).alias("pm10"),
        (F.lit(40) + F.col("o_orderkey") % 50).cast("double").alias("humidity"),
        (F.lit(15) + F.col("o_orderkey") % 20).cast("double").alias("temperature"),
        F.lit("kaggle").alias("source"),
        F.col("o_orderkey").alias("event_id"),
    )
