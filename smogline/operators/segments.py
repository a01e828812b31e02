"""Windows and fills over long series, cut into segments of a fixed number of rows.

A window partitioned by key puts a whole series into one task. Here a series is numbered first and then cut:

* ``positions``: rows are range-partitioned by (key, time), so that one key spreads over many tasks; each partition's rows are
  numbered where they lie, and prefix sums of the row counts per key (one row per key and partition) make them positions.
* ``by_segments``: a job whose windows reach at most ``back`` rows back and ``ahead`` rows ahead runs on segments of ``rows`` rows;
  each segment also gets the last ``back`` rows of the one before and the first ``ahead`` rows of the next. Every
  row counts, whatever the time between them, so results are those of the whole series.
* ``regularize``, ``interpolate`` and ``fill``: what lies arbitrarily far away is carried. Each segment reports its first and last
  known value; a window over these reports (one row per segment) tells each segment what is known before and after it.

Rows with equal key and time follow one another in the order of their other columns; a null key is a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions.columns import round_half
from smogline.operators import windows as W
from smogline.operators.windows import KEY, TS
from smogline.session import stored

#: Rows of one segment.
ROWS = 4096


def positions(df: DataFrame, key: str = KEY, ts: str = TS, partitions: int | None = None) -> DataFrame:
    """``df`` (as a written table) with ``_pos``, the number of rows of the key that come before."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sortable = [c for c, t in df.dtypes if c not in (key, ts) and not t.startswith("map")]
    ranged = (df.repartitionByRange(n, key, ts).sortWithinPartitions(key, ts, *sortable)
              .withColumn("_at", F.monotonically_increasing_id()))
    ranged = stored(ranged, "series").withColumn("_piece", F.shiftright("_at", 33))
    pieces = ranged.groupBy(F.col(key).alias("_key"), F.col("_piece").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_skip", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    same = ranged[key].eqNullSafe(pieces["_key"]) & (ranged["_piece"] == pieces["_of"])
    return ranged.join(pieces, same).select(*df.columns, (F.col("_skip") + F.col("_at") - F.col("_first")).alias("_pos"))


def by_segments(df: DataFrame, job: Callable[[DataFrame, list[str]], DataFrame], back: int, ahead: int, key: str = KEY,
                ts: str = TS, rows: int = ROWS) -> DataFrame:
    """``job(frame, keys)``, whose windows are partitioned by ``keys`` and reach ``back`` rows back and ``ahead`` rows ahead."""
    if rows <= max(back, ahead):
        raise ValueError("a segment must be longer than the windows' reach")
    placed = positions(df, key, ts)
    segment, at = F.floor(F.col("_pos") / rows), F.col("_pos") % rows
    copies = F.array(F.struct(segment.alias("_segment"), F.lit(False).alias("_copy")),
                     F.when(at >= rows - back, F.struct((segment + 1).alias("_segment"), F.lit(True).alias("_copy"))),
                     F.when((at < ahead) & (segment > 0), F.struct((segment - 1).alias("_segment"), F.lit(True).alias("_copy"))))
    dealt = placed.select(*df.columns, F.inline(F.filter(copies, lambda c: c.isNotNull())))
    return job(dealt, [key, "_segment"]).filter(~F.col("_copy")).drop("_segment", "_copy")


def hourly_features(hourly: DataFrame, key: str = KEY, ts: str = TS, rows: int = ROWS) -> DataFrame:
    """``windows.hourly_features`` (row-counting lags, trailing statistics, changes, target) on segments."""
    back = max(max(K.HOURLY_LAGS), max(n for n, _ in K.HOURLY_ROLLING))
    return by_segments(hourly, lambda d, keys: W.hourly_features(d, keys, ts), back, K.FORECAST_HORIZON_H, key, ts, rows)


def zscore_anomalies(hourly: DataFrame, col: str = "aqi", size: int = 168, key: str = KEY, ts: str = TS, rows: int = ROWS) -> DataFrame:
    """The trailing z-score detector on segments."""
    def job(d: DataFrame, keys: list[str]) -> DataFrame:
        stats = W.rolling_columns(col, [(size, "7d")], W._w(keys, ts), ("mean", "std"))
        return W.zscore_anomalies(d.withColumns(stats), col, f"{col}_roll_mean_7d", f"{col}_roll_std_7d")

    return by_segments(hourly, job, size, 0, key, ts, rows)


def sequences(df: DataFrame, features: Sequence[str], length: int = 72, horizon: int = 24, key: str = KEY, ts: str = TS,
              rows: int = ROWS) -> DataFrame:
    """``windows.sequences`` on segments."""
    def job(d: DataFrame, keys: list[str]) -> DataFrame:
        return W.sequences(d, features, length, horizon, keys, ts, keep=(key, "_segment", "_copy"))

    return by_segments(df, job, length - 1, horizon, key, ts, rows)


def segmented(df: DataFrame, key: str = KEY, ts: str = TS, rows: int = ROWS) -> DataFrame:
    """``df`` with ``_pos`` and ``_segment``, as a written table."""
    return stored(positions(df, key, ts).withColumn("_segment", F.floor(F.col("_pos") / rows)), "segments")


def carried(parts: DataFrame, known: dict[str, Column], key: str = KEY) -> DataFrame:
    """(key, _segment, _before_x, _after_x): for every ``known`` x, the last non-null struct of the segments before and the
    first one of those after. The structs begin with the position."""
    reports = parts.groupBy(key, "_segment").agg(*[f(e).alias(f"_{n}_{x}") for x, e in known.items()
                                                   for f, n in ((F.min, "first"), (F.max, "last"))])
    order = Window.partitionBy(key)
    before = order.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    after = order.orderBy(F.desc("_segment")).rowsBetween(Window.unboundedPreceding, -1)
    return reports.select(F.col(key).alias("_key"), F.col("_segment").alias("_of"), *[c for x in known for c in (
        F.last(f"_last_{x}", ignorenulls=True).over(before).alias(f"_before_{x}"),
        F.last(f"_first_{x}", ignorenulls=True).over(after).alias(f"_after_{x}"))])


def known_around(parts: DataFrame, cols: Sequence[str], key: str = KEY, ts: str = TS) -> DataFrame:
    """``parts`` with ``_p_c`` and ``_n_c`` for every column c: (pos, v, t) of the last known value up to the row and of the first one
    from the row on, in whichever segment."""
    t = F.unix_seconds(ts)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col(c).alias("v"), t.alias("t"))) for c in cols}
    carry = carried(parts, known, key)
    rows = parts.join(carry, parts[key].eqNullSafe(carry["_key"]) & (parts["_segment"] == carry["_of"])).drop("_key", "_of")
    local = Window.partitionBy(key, "_segment")
    up = local.orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    down = local.orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_p_{c}": F.coalesce(F.last(e, ignorenulls=True).over(up), F.col(f"_before_{c}")) for c, e in known.items()})
    rows = rows.withColumns({f"_n_{c}": F.coalesce(F.last(e, ignorenulls=True).over(down), F.col(f"_after_{c}")) for c, e in known.items()})
    return rows.drop(*[f"_{n}_{c}" for c in cols for n in ("before", "after")])


def regularize(df: DataFrame, key: str = KEY, ts: str = TS, step: str = "1 hour", rows: int = ROWS) -> DataFrame:
    """``windows.regularize`` on segments: a segment's last row fills the gap up to the first row of the next one."""
    parts = segmented(df, key, ts, rows)
    carry = carried(parts, {"row": F.struct(F.col("_pos").alias("pos"), F.col(ts).alias("t"))}, key)
    joined = parts.join(carry, parts[key].eqNullSafe(carry["_key"]) & (parts["_segment"] == carry["_of"]))
    following = F.coalesce(F.lead(ts, 1).over(Window.partitionBy(key, "_segment").orderBy("_pos")), F.col("_after_row.t"))
    return W.explode_gaps(joined.withColumn("_next", following), [c for c in df.columns if c not in (key, ts)], key, ts, step)


def interpolate(df: DataFrame, cols: Sequence[str], key: str = KEY, ts: str = TS, limit: int = 6, digits: int = 6,
                rows: int = ROWS) -> DataFrame:
    """``windows.interpolate`` on segments: linear in time, forward, at most ``limit`` rows of a run of nulls."""
    around = known_around(segmented(df, key, ts, rows), cols, key, ts)
    t = F.unix_seconds(ts)
    filled = {}
    for c in cols:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        between = round_half(p.v + (n.v - p.v) * (t - p.t).cast("double") / (n.t - p.t).cast("double"), digits)
        filled[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(
            F.col("_pos") - p.pos <= limit, F.when(n.isNull(), p.v).otherwise(between))
    return around.withColumns(filled).select(*df.columns)


def fill(df: DataFrame, cols: Sequence[str], key: str = KEY, ts: str = TS, rows: int = ROWS) -> DataFrame:
    """Forward, then backward fill within the key. A key with any known value has no gap left, and one without has no median
    either, so this is all that ``windows.fill_forward_back_median`` can fill."""
    around = known_around(segmented(df, key, ts, rows), cols, key, ts)
    return around.withColumns({c: F.coalesce(c, F.col(f"_p_{c}.v"), F.col(f"_n_{c}.v")) for c in cols}).select(*df.columns)
