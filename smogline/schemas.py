"""Explicit schemas of the platform's tables and raw inputs."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)

_V = StructType([StructField("v", DoubleType())])

API_DOCUMENT = StructType([
    StructField("status", StringType()),
    StructField("data", StructType([
        StructField("aqi", StringType()),  # int or text such as '-'
        StructField("idx", IntegerType()),
        StructField("dominentpol", StringType()),
        StructField("city", StructType([
            StructField("name", StringType()), StructField("url", StringType()),
            StructField("geo", ArrayType(DoubleType())),
        ])),
        StructField("time", StructType([StructField("iso", StringType())])),
        StructField("iaqi", StructType([StructField(k, _V) for k in
                                        ["pm25", "pm10", "co", "no2", "o3", "so2", "h", "t", "p", "w"]])),
    ])),
])

API_PATH_COLUMNS = [StructField(c, StringType()) for c in ["queried_city", "year", "month", "day"]]
API_DOCUMENT_WITH_PATH = StructType(API_DOCUMENT.fields + API_PATH_COLUMNS)

# raw station CSV: every column read as text, cleaned explicitly afterwards
STATION_CSV_COLUMNS = ["Station ID", "AQI index", "Location", "Station name", "Url", "Dominent pollutant", "CO",
                       "Dew", "Humidity", "NO2", "O3", "Pressure", "PM10", "PM2.5", "SO2", "Temperature", "Wind",
                       "Data Time S", "Data Time Tz", "Status", "Alert level"]
STATION_CSV = StructType([StructField(c, StringType()) for c in STATION_CSV_COLUMNS])

FACT_AQI = StructType([
    StructField("waqi_idx", IntegerType()), StructField("measured_at", TimestampType()),
    StructField("aqi", DoubleType()), StructField("dominant_pollutant", StringType()),
    *[StructField(c, DoubleType()) for c in ["pm25", "pm10", "co", "no2", "o3", "so2", "humidity", "temperature",
                                             "pressure", "wind"]],
    StructField("source", StringType()), StructField("ingested_at", StringType()),
    StructField("queried_city", StringType()), StructField("year", StringType()), StructField("month", StringType()),
])

DIM_STATION = StructType([
    StructField("waqi_idx", IntegerType()), StructField("station_name", StringType()),
    StructField("queried_city", StringType()), StructField("lat", DoubleType()), StructField("lon", DoubleType()),
    StructField("url", StringType()), StructField("source", StringType()),
])


def assert_schema(df, expected: StructType, strict_types: bool = True):
    """Fail fast at a layer boundary when columns are missing or typed differently."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    wrong = [f.name for f in expected.fields if f.name in have and strict_types and have[f.name] != f.dataType]
    if missing or wrong:
        raise ValueError(f"schema mismatch: missing={missing} wrong_type={wrong}")
    return df
