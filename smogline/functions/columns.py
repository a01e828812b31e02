"""Column expressions (JVM-side, codegen-friendly). No Python UDFs here."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline import constants as K

__all__ = [
    "col_of", "aqi_level", "scaled", "exact_sum", "exact_mean", "exact_avg", "rounded_avg", "round_half", "null_if_tokens",
    "parse_number", "clean_numeric", "timestamp_with_offset", "split_pair", "keyword_category",
    "city_from_url", "cyclical", "is_weekend", "is_dry_season", "year_text", "month_text",
    "weekday_mon0", "null_last_key", "label_lookup",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def aqi_level(value: str | Column, levels: Sequence[tuple[float, str]] = K.AQI_LEVELS,
              top: str = K.AQI_TOP_LEVEL) -> Column:
    """Level ladder on inclusive upper bounds; null stays null (not 'Hazardous')."""
    v = col_of(value)
    expr = None
    for bound, label in levels:
        cond = v <= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(v.isNotNull(), F.lit(top))


# measurements are summed at a fixed resolution of 1e-6 as integers: exact and
# independent of summation order (hence of partitioning), cheap (long-backed decimals)
EXACT_SCALE = 1_000_000.0


def scaled(value: str | Column) -> Column:
    """``value`` in units of 1e-6, rounded half-even, as a long-backed decimal."""
    return F.rint(col_of(value) * F.lit(EXACT_SCALE)).cast("long").cast("decimal(18,0)")


def exact_sum(value: str | Column) -> Column:
    """Exact sum in units of 1e-6 (decimal(28,0): no overflow for any realistic volume)."""
    return F.sum(scaled(value))


def exact_mean(scaled_sum: Column, count: Column) -> Column:
    """Mean from an exact scaled sum and a count (null when the count is 0)."""
    return F.try_divide(scaled_sum.cast("double") / F.lit(EXACT_SCALE), count)


def exact_avg(value: str | Column) -> Column:
    """Mean as exact scaled sum / count (deterministic across partitionings)."""
    v = col_of(value)
    return exact_mean(exact_sum(v), F.count(v))


def round_half(value: str | Column, digits: int = 2) -> Column:
    """Round with a 1e-9 nudge so binary noise never decides a .5 tie."""
    return F.round(col_of(value) + F.lit(1e-9), digits).cast("double")


def rounded_avg(value: str | Column, digits: int = 2) -> Column:
    return round_half(exact_avg(value), digits)


def null_if_tokens(value: str | Column, tokens: Sequence[str] = K.NULL_TOKENS) -> Column:
    """Junk tokens ('-', '', '#NAME?', 'N/A') become null; text is trimmed."""
    v = F.trim(col_of(value).cast("string"))
    return F.when(v.isin(list(tokens)), F.lit(None).cast("string")).otherwise(v)


def parse_number(value: str | Column, tokens: Sequence[str] = K.NULL_TOKENS) -> Column:
    """Text to double: tokens to null, thousands separators removed, bad text to null."""
    v = null_if_tokens(value, tokens)
    return F.replace(v, F.lit(","), F.lit("")).try_cast("double")  # literal replace, no regex


def clean_numeric(value: Column, data_type) -> Column:
    """Numeric cleaning for native, text, or struct-of-choices columns.

    ``data_type`` is the column's Spark type (read from ``df.schema``), so the
    expression is chosen at plan time and no row-level branching on type is needed.
    """
    from pyspark.sql.types import NumericType, StringType, StructType

    if isinstance(data_type, NumericType):
        return value.cast("double")
    if isinstance(data_type, StringType):
        return parse_number(value)
    if isinstance(data_type, StructType):
        names = [f.name for f in data_type.fields]
        order = [n for n in ("double", "float", "long", "int", "string") if n in names]
        parts = [clean_numeric(value.getField(n), data_type[n].dataType) for n in order]
        return F.coalesce(*parts) if parts else F.lit(None).cast("double")
    return value.cast("string").try_cast("double")


def timestamp_with_offset(text: str | Column, offset: str | Column,
                          fmt: str = "yyyy-MM-dd HH:mm:ss xxx") -> Column:
    """Local date-time text plus '+07:00' style offset to an instant; bad text to null."""
    return F.try_to_timestamp(F.concat_ws(" ", col_of(text), col_of(offset)), F.lit(fmt))


def split_pair(text: str | Column, index: int, sep: str = ",") -> Column:
    """Element ``index`` of 'a,b' text as double; missing or bad part to null."""
    return F.get(F.split(col_of(text), sep), index).try_cast("double")


def keyword_category(text: str | Column, table: Mapping[str, Sequence[str]] = K.CITY_KEYWORDS_ETL,
                     case_insensitive: bool = False, default: str | None = None,
                     null_label: str | None = None) -> Column:
    """First label whose keyword occurs in ``text`` (ordered table, first match wins)."""
    v = col_of(text)
    probe = F.lower(v) if case_insensitive else v
    expr = F.when(v.isNull(), F.lit(null_label))
    for label, words in table.items():
        cond = F.lit(False)
        for w in words:
            cond = cond | F.contains(probe, F.lit(w.lower() if case_insensitive else w))
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def city_from_url(url: str | Column, aliases: Mapping[str, str] = K.URL_CITY_ALIASES,
                  pattern: str = K.URL_CITY_PATTERN, unknown: str = "unknown") -> Column:
    """City slug from a station URL via regex group, alias map, else the group."""
    group = F.regexp_extract(col_of(url), pattern, 1)
    mapping = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    found = F.coalesce(F.try_element_at(mapping, group), group)
    return F.when(col_of(url).isNull() | (group == ""), F.lit(unknown)).otherwise(found)


def cyclical(value: str | Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) encoding of a periodic integer."""
    angle = F.lit(2 * math.pi) * col_of(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def is_weekend(ts: str | Column) -> Column:
    return F.when(F.dayofweek(col_of(ts)).isin(1, 7), 1).otherwise(0)


def is_dry_season(ts: str | Column) -> Column:
    return F.when(F.month(col_of(ts)).isin(*K.DRY_SEASON_MONTHS), 1).otherwise(0)


def weekday_mon0(ts: str | Column) -> Column:
    """Day of week with Monday = 0 (Spark's dayofweek has Sunday = 1)."""
    return F.weekday(col_of(ts))


def year_text(ts: str | Column) -> Column:
    return F.year(col_of(ts)).cast("string")


def month_text(ts: str | Column) -> Column:
    return F.lpad(F.month(col_of(ts)).cast("string"), 2, "0")


def null_last_key(value: str | Column) -> Column:
    """Sort/mode key that places null after every real text value."""
    return F.coalesce(col_of(value), F.lit("￿"))


def label_lookup(value: str | Column, table: Mapping[str, str]) -> Column:
    """Literal-map lookup with fallback to the code itself (small fixed tables only)."""
    mapping = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(mapping, col_of(value)), col_of(value))
