"""Data-quality metrics and checks as Spark aggregates.

The fact metrics (counts, null counts, range violations, city coverage, invalid
sources, fresh rows) come from ONE aggregate pass over the full table; the
dimension metrics from one more. Checks are emitted as a long DataFrame
``(check, table, column, value, threshold, passed, message)`` built with
``inline`` over the one-row aggregates, so no join or driver round-trip is needed.
The set aggregates hold distinct city/source names only (bounded by the domain).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogline import constants as K

CHECK_FIELDS = "check string, table string, column string, value double, threshold double, passed boolean, message string"


def fact_metrics(fact: DataFrame, now: dt.datetime | str, freshness_hours: int = K.DQ_FRESHNESS_HOURS,
                 null_columns: Sequence[str] = K.DQ_NULL_COLUMNS) -> DataFrame:
    """One aggregate pass over the whole table."""
    cutoff = F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(freshness_hours))
    invalid = F.when(~F.col("source").isin(*K.VALID_SOURCES), F.col("source"))
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns],
        F.count_if((F.col("aqi") < K.AQI_MIN) | (F.col("aqi") > K.AQI_MAX)).alias("aqi_out_of_range"),
        F.array_sort(F.collect_set("queried_city")).alias("cities"),
        F.array_sort(F.collect_set(invalid)).alias("invalid_sources"),
        F.count_if(F.try_to_timestamp(F.col("ingested_at")) >= cutoff).alias("fresh_rows"),
    ).withColumn("distinct_cities", F.array_join("cities", ",")).withColumn(
        "invalid_source_list", F.array_join("invalid_sources", ","))


def value_rows(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """(column, value, n, status) as rows, however many values there are: every expected value, ``missing`` if it has no rows, and
    every other non-null value, ``unexpected``. Nothing is collected into one row."""
    found = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    known = df.sparkSession.createDataFrame([(v, True) for v in expected], "value string, known boolean")
    n, known_ = F.coalesce("n", F.lit(0)), F.coalesce("known", F.lit(False))
    return found.join(known, "value", "full").select(
        F.lit(column).alias("column"), "value", n.alias("n"),
        F.when(known_ & (n > 0), "present").when(known_, "missing").otherwise("unexpected").alias("status"))


def dim_metrics(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count(F.lit(1)).alias("total_stations"),
                   F.array_sort(F.collect_set("queried_city")).alias("cities"))


def _row(check: str, table: str, column: str | None, value: Column, threshold: float | None,
         passed: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).cast("string").alias("column"),
        value.cast("double").alias("value"), F.lit(threshold).cast("double").alias("threshold"),
        passed.alias("passed"), message.alias("message"))


def _missing(cities: Column, expected: Sequence[str]) -> Column:
    return F.array_except(F.array(*[F.lit(c) for c in sorted(expected)]), cities)


def fact_checks(m: DataFrame, min_rows: int = K.DQ_MIN_ROW_COUNT, max_null_pct: float = K.DQ_MAX_NULL_PERCENT,
                expected: Sequence[str] = K.EXPECTED_CITIES, null_columns: Sequence[str] = K.DQ_NULL_COLUMNS) -> DataFrame:
    total = F.col("total_rows")
    rows = [_row("row_count", "fact_aqi", None, total, float(min_rows), total >= min_rows,
                 F.format_string("fact_aqi row count: %d (min: %d)", total, F.lit(min_rows)))]
    for c in null_columns:
        pct = F.when(total > 0, F.round(F.col(f"null_{c}") / total * 100 + F.lit(1e-9), 2)).otherwise(F.lit(0.0))
        rows.append(_row("null_pct", "fact_aqi", c, pct, max_null_pct, pct <= max_null_pct,
                         F.concat(F.lit(f"fact_aqi.{c} null%: "), pct.cast("string"), F.lit(f"% (max: {max_null_pct}%)"))))
    bad = F.col("aqi_out_of_range")
    rows.append(_row("aqi_range", "fact_aqi", "aqi", bad, 0.0, bad == 0,
                     F.format_string("AQI out of range [%d-%d]: %d records", F.lit(K.AQI_MIN), F.lit(K.AQI_MAX), bad)))
    miss = _missing(F.col("cities"), expected)
    rows.append(_row("city_coverage", "fact_aqi", "queried_city", F.size(miss), 0.0, F.size(miss) == 0,
                     F.when(F.size(miss) == 0, F.lit("All cities present"))
                     .otherwise(F.concat(F.lit("Missing cities: "), F.array_join(miss, ",")))))
    inv = F.col("invalid_sources")
    rows.append(_row("source_validity", "fact_aqi", "source", F.size(inv), 0.0, F.size(inv) == 0,
                     F.when(F.size(inv) == 0, F.lit("All sources valid"))
                     .otherwise(F.concat(F.lit("Invalid sources: "), F.array_join(inv, ",")))))
    fresh = F.col("fresh_rows")
    rows.append(_row("freshness", "fact_aqi", "ingested_at", fresh, 1.0, fresh > 0,
                     F.format_string("%d rows ingested in the freshness window", fresh)))
    return m.select(F.inline(F.array(*rows)))


def dim_checks(m: DataFrame, expected: Sequence[str] = K.EXPECTED_CITIES) -> DataFrame:
    total = F.col("total_stations")
    miss = _missing(F.col("cities"), expected)
    rows = [
        _row("dim_station_row_count", "dim_station", None, total, 1.0, total > 0,
             F.format_string("dim_station: %d stations", total)),
        _row("dim_station_city_coverage", "dim_station", "queried_city", F.size(miss), 0.0, F.size(miss) == 0,
             F.when(F.size(miss) == 0, F.lit("All cities have stations"))
             .otherwise(F.concat(F.lit("Stations missing for cities: "), F.array_join(miss, ",")))),
    ]
    return m.select(F.inline(F.array(*rows)))


def run_checks(fact: DataFrame, dim: DataFrame, now: dt.datetime | str, **kw) -> DataFrame:
    """All eleven check rows (fact + freshness + dimension)."""
    return fact_checks(fact_metrics(fact, now), **kw).unionByName(dim_checks(dim_metrics(dim)))


def summarize(checks: DataFrame) -> DataFrame:
    """Overall gate row: all passed, passed/total, names of failed checks."""
    name = F.concat_ws(".", F.col("check"), F.coalesce(F.col("column"), F.lit("")))
    return checks.agg(
        F.bool_and("passed").alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), name))), ",").alias("failed"),
    )


def gate(checks: DataFrame) -> bool:
    """Block a downstream build: one tiny aggregate action, returns True when all passed."""
    row = summarize(checks).first()
    return bool(row["quality_passed"])
