"""Time-series window operators over keyed, time-ordered series.

All windows of one key share one ``Window`` spec, so Catalyst plans a single
Exchange + Sort for every lag/frame/lead added in one projection. They run after
pre-aggregation (hourly/daily), where a key's series is bounded by the time grid,
not by the raw reading volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions.columns import (
    cyclical, exact_avg, exact_mean, is_dry_season, scaled, is_weekend, month_text, round_half, weekday_mon0, year_text,
)

KEY, TS = "queried_city", "measured_at"


def _w(key: str | Sequence[str], ts: str):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(ts)


def _so_far(key: str | Sequence[str], order: str | Column):
    return _w(key, order).rowsBetween(Window.unboundedPreceding, 0)


def hourly(fact: DataFrame, key: str = KEY, ts: str = TS, measures: Sequence[str] = K.HOURLY_MEASURES) -> DataFrame:
    """Mean of each measure per (key, hour); hours without aqi dropped."""
    return (
        fact.groupBy(key, F.date_trunc("hour", F.col(ts)).alias(ts))
        .agg(*[exact_avg(m).alias(m) for m in measures])
        .filter(F.col("aqi").isNotNull())
    )


def daily_means(fact: DataFrame, key: str = KEY, ts: str = TS, measures: Sequence[str] = K.HOURLY_MEASURES) -> DataFrame:
    """Mean of each measure per (key, day) as a midnight timestamp; days without aqi dropped."""
    return (
        fact.groupBy(key, F.date_trunc("day", F.col(ts)).alias(ts))
        .agg(*[exact_avg(m).alias(m) for m in measures if m in fact.columns])
        .filter(F.col("aqi").isNotNull())
    )


def lag_columns(cols: Sequence[str], lags: Sequence[int], w, unit: str = "h") -> dict[str, Column]:
    return {f"{c}_lag_{n}{unit}": F.lag(c, n).over(w) for n in lags for c in cols}


def rolling_columns(col: str, sizes: Sequence[tuple[int, str]], w, stats: Sequence[str] = ("mean", "std", "min", "max"),
                    include_current: bool = False, min_periods: str | int | None = None,
                    std_null_as: float | None = None, digits: int = 6) -> dict[str, Column]:
    """Trailing frames of n rows (excluding the current row unless asked).

    ``min_periods``: None (any), an int, 'full' (= n) or 'half' (= max(1, n // 2)); a
    frame with fewer non-null values gives null. Means use exact decimal sums; mean
    and std are rounded to ``digits`` so results do not depend on summation order.
    """
    out: dict[str, Column] = {}
    for n, label in sizes:
        frame = w.rowsBetween(-(n - 1), 0) if include_current else w.rowsBetween(-n, -1)
        cnt = F.count(col).over(frame)
        need = {None: 1, "full": n, "half": max(1, n // 2)}.get(min_periods, min_periods)
        ok = cnt >= F.lit(need)
        mean = exact_mean(F.sum(scaled(col)).over(frame), cnt)
        exprs = {
            "mean": round_half(mean, digits),
            "std": round_half(F.stddev(col).over(frame), digits),
            "min": F.min(col).over(frame),
            "max": F.max(col).over(frame),
        }
        for s in stats:
            e = F.when(ok, exprs[s])
            if s == "std" and std_null_as is not None:
                e = F.coalesce(e, F.lit(float(std_null_as)))
            out[f"{col}_roll_{s}_{label}"] = e
    return out


def change_columns(col: str, w, diff_name: str = "aqi_diff_1h", pct_name: str | None = "aqi_pct_change_24h",
                   pct_lag: int = 24, extra_shift: int = 0, scale: float = 1.0) -> dict[str, Column]:
    """Difference to the previous row and relative change over ``pct_lag`` rows (0 -> null)."""
    shifted = lambda c, n: F.lag(c, n + extra_shift).over(w)
    cur = F.col(col) if extra_shift == 0 else F.lag(col, extra_shift).over(w)
    out = {diff_name: cur - shifted(col, 1)}
    if pct_name:
        base = shifted(col, pct_lag)
        pct = F.try_divide(cur - base, F.nullif(base, F.lit(0.0)))
        out[pct_name] = pct * F.lit(scale) if scale != 1.0 else pct
    return out


def time_columns(ts: str = TS) -> dict[str, Column]:
    hs, hc = cyclical(F.hour(ts), 24)
    ms, mc = cyclical(F.month(ts), 12)
    return {
        "hour": F.hour(ts), "dow": F.dayofweek(ts), "month": F.month(ts),
        "is_weekend": is_weekend(ts), "is_dry_season": is_dry_season(ts),
        "hour_sin": hs, "hour_cos": hc, "month_sin": ms, "month_cos": mc,
    }


def hourly_features(hourly_df: DataFrame, key: str = KEY, ts: str = TS, horizon: int = K.FORECAST_HORIZON_H,
                    notebook_mode: bool = False) -> DataFrame:
    """The hourly ML feature table: lags, trailing stats, changes, calendar, target, partitions.

    ``notebook_mode`` applies the analysis variant: full windows required, changes
    shifted one more row (no leakage of the current value).
    """
    w = _w(key, ts)
    cols: dict[str, Column] = {}
    cols.update(lag_columns(["aqi", "pm25"], K.HOURLY_LAGS, w))
    cols.update(rolling_columns("aqi", K.HOURLY_ROLLING, w, min_periods="full" if notebook_mode else None))
    cols.update(change_columns("aqi", w, extra_shift=1 if notebook_mode else 0))
    cols.update(time_columns(ts))
    cols["aqi_target"] = F.lead("aqi", horizon).over(w)
    out = hourly_df.withColumns(cols)
    return out.withColumns({"year": year_text(ts), "month_part": month_text(ts)})


def regularize(df: DataFrame, key: str = KEY, ts: str = TS, step: str = "1 hour") -> DataFrame:
    """Insert the missing steps of each key's [min, max] range (values null).

    One pass: every row emits itself plus the empty steps up to the next row of its
    key (``lead``), so the input is evaluated once and no join is needed; the window
    shares the key partitioning of the windows that usually follow.
    """
    values = [c for c in df.columns if c not in (key, ts)]
    return explode_gaps(df.withColumn("_next", F.lead(ts, 1).over(_w(key, ts))), values, key, ts, step)


def explode_gaps(df: DataFrame, values: Sequence[str], key: str = KEY, ts: str = TS, step: str = "1 hour") -> DataFrame:
    """Each row and the empty steps up to its ``_next`` one (null: none)."""
    gap_end = F.coalesce(F.col("_next") - F.expr(f"INTERVAL {step}"), F.col(ts))
    stamped = df.select(key, ts, F.struct(*values).alias("_v"), gap_end.alias("_end"))
    filled = stamped.select(key, F.col(ts).alias("_first"), "_v",
                            F.explode(F.sequence(F.col(ts), F.col("_end"), F.expr(f"INTERVAL {step}"))).alias(ts))
    return filled.select(key, ts, *[F.when(F.col(ts) == F.col("_first"), F.col(f"_v.{c}")).alias(c) for c in values])


def interpolate(df: DataFrame, cols: Sequence[str], key: str = KEY, ts: str = TS, limit: int = 6,
                digits: int = 6) -> DataFrame:
    """Linear-in-time interpolation of null runs, filling at most ``limit`` steps of a run.

    Forward only: leading nulls stay null; trailing nulls carry the last value.
    """
    w = _w(key, ts)
    before, after = _so_far(key, ts), _so_far(key, F.desc(ts))
    t = F.unix_seconds(F.col(ts))
    out = df.withColumn("_rn", F.row_number().over(w))
    # the last known (value, time, row) in either direction of time: both frames only grow, so each row is added once
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), t.alias("t"), F.col("_rn").alias("rn")))
             for c in cols}
    out = out.withColumns({f"_p_{c}": F.last(e, ignorenulls=True).over(before) for c, e in known.items()})
    out = out.withColumns({f"_n_{c}": F.last(e, ignorenulls=True).over(after) for c, e in known.items()})
    exprs = {}
    for c in cols:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        lin = p.v + (n.v - p.v) * (t - p.t).cast("double") / (n.t - p.t).cast("double")
        filled = F.when(n.isNull(), p.v).otherwise(round_half(lin, digits))
        exprs[c] = F.when(F.col(c).isNotNull(), F.col(c)).when((F.col("_rn") - p.rn) <= limit, filled)
    return out.withColumns(exprs).drop("_rn", *[f"_p_{c}" for c in cols], *[f"_n_{c}" for c in cols])


def fill_forward_back_median(df: DataFrame, cols: Sequence[str], key: str = KEY, ts: str = TS) -> DataFrame:
    """Forward fill, then backward fill, then the key's median, each within the key.

    The backward fill is a forward fill in descending time (a frame that only grows, hence linear). The median
    is a window aggregate over the same key partition the fills already use, so it adds no shuffle and no join.
    """
    before, after = _so_far(key, ts), _so_far(key, F.desc(ts))
    whole = Window.partitionBy(key)
    return df.withColumns({
        c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(before), F.last(c, ignorenulls=True).over(after),
                      F.median(c).over(whole))
        for c in cols
    })


def daily_features(fact: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Daily table for the next-day forecast: lags 1,2,3,5,7 days; trailing 3/7/14-day
    stats with min count max(1, n/2) and std null -> 0; diff; calendar; next-day target."""
    return daily_feature_columns(daily_means(fact, key, ts), key, ts)


def filled_daily(fact: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Daily means on a grid without missing days: forward, then backward fill, then the key's median."""
    grid = regularize(daily_means(fact, key, ts), key, ts, "1 day")
    return fill_forward_back_median(grid, [c for c in grid.columns if c not in (key, ts)], key, ts)


def daily_feature_columns(d: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    w = _w(key, ts)
    cols: dict[str, Column] = {}
    cols.update(lag_columns(["aqi"], K.DAILY_LAGS, w, unit="d"))
    cols.update(rolling_columns("aqi", K.DAILY_ROLLING, w, stats=("mean", "std"), min_periods="half", std_null_as=0.0))
    cols["aqi_diff_1d"] = F.col("aqi") - F.lag("aqi", 1).over(w)
    ms, mc = cyclical(F.month(ts), 12)
    ds, dc = cyclical(weekday_mon0(ts), 7)
    cols.update({"month_sin": ms, "month_cos": mc, "dow_sin": ds, "dow_cos": dc,
                 "is_weekend": F.when(weekday_mon0(ts) >= 5, 1).otherwise(0), "is_dry_season": is_dry_season(ts),
                 "aqi_target": F.lead("aqi", 1).over(w)})
    return d.withColumns(cols)


def rolling_mean_including_current(df: DataFrame, col: str, n: int, key: str = KEY, ts: str = TS,
                                   name: str | None = None, digits: int = 6) -> DataFrame:
    w = _w(key, ts).rowsBetween(-(n - 1), 0)
    mean = exact_mean(F.sum(scaled(col)).over(w), F.count(col).over(w))
    return df.withColumn(name or f"{col}_roll_{n}", round_half(mean, digits))


def zscore_anomalies(df: DataFrame, col: str = "aqi", mean: str = "aqi_roll_mean_7d", std: str = "aqi_roll_std_7d",
                     k: float = 3.0, digits: int = 6) -> DataFrame:
    """z = (x - mean) / std with std 0 -> null; flag |z| > k (null score -> 0)."""
    z = F.try_divide(F.col(col) - F.col(mean), F.nullif(F.col(std), F.lit(0.0)))
    return df.withColumn("zscore_7d", round_half(z, digits)).withColumn(
        "is_anom_zscore", F.when(F.abs(F.col("zscore_7d")) > k, 1).otherwise(0))


def sequences(df: DataFrame, features: Sequence[str], length: int = 72, horizon: int = 24,
              key: str | Sequence[str] = KEY, ts: str = TS, keep: Sequence[str] = ()) -> DataFrame:
    """Sliding windows of ``length`` steps ending at each row, target ``horizon`` steps after
    the end; windows with any null feature or no target are skipped.

    Each feature becomes its own narrow ``array<double>`` column (not an array of structs).
    """
    w = _w(key, ts)
    frame = w.rowsBetween(-(length - 1), 0)
    complete = F.least(*[F.col(f).isNotNull().cast("int") for f in features]) if len(features) > 1 \
        else F.col(features[0]).isNotNull().cast("int")
    out = df.select(
        *(keep or [key]), F.col(ts).alias("end_at"), F.lead("aqi", horizon).over(w).alias("target"),
        F.count(F.lit(1)).over(frame).alias("_n"),
        F.min(complete).over(frame).alias("_ok"),
        *[F.collect_list(F.col(f).cast("double")).over(frame).alias(f"seq_{f}") for f in features],
    )
    return out.filter((F.col("_n") == length) & (F.col("_ok") == 1) & F.col("target").isNotNull()).drop("_n", "_ok")


def decompose(df: DataFrame, col: str = "aqi", period: int = 7, key: str = KEY, ts: str = TS,
              digits: int = 6, step: str = "1 day", limit: int = 5) -> DataFrame:
    """Classical additive split: centred moving average trend, mean seasonal by phase
    (centred to sum 0), residual = x - trend - seasonal.

    The series is put on a grid of ``step`` first and gaps of ``col`` are interpolated linearly, up to ``limit`` steps of
    a run: a missing day shifts neither the frame nor the phases after it. Steps still without a value are left out.
    """
    df = interpolate(regularize(df, key, ts, step), [col], key, ts, limit, digits)
    w = _w(key, ts)
    half = period // 2
    frame = w.rowsBetween(-half, half)
    idx = F.row_number().over(w) - 1
    trend = F.when(F.count(col).over(frame) == period,
                   exact_mean(F.sum(scaled(col)).over(frame), F.lit(float(period))))
    t = df.withColumns({"_phase": idx % period, "trend": round_half(trend, digits)})
    t = t.withColumn("_detr", F.col(col) - F.col("trend"))
    phase_mean = t.groupBy(key, "_phase").agg(F.avg("_detr").alias("_pm"))
    centred = phase_mean.withColumn("seasonal", round_half(
        F.col("_pm") - F.avg("_pm").over(Window.partitionBy(key)), digits)).drop("_pm")
    out = t.filter(F.col(col).isNotNull()).join(centred, [key, "_phase"], "left")
    return out.withColumn("resid", round_half(F.col(col) - F.col("trend") - F.col("seasonal"), digits)).drop(
        "_phase", "_detr")


def bucketed(df: DataFrame, fn, key: str = KEY, ts: str = TS, bucket_steps: int = 720, back: int = 168,
             ahead: int = 24, step_seconds: int = 3600) -> DataFrame:
    """Run a bounded-frame window job on time buckets instead of whole keys.

    Each row is assigned to bucket floor(step / bucket_steps) of its key; the last
    ``back`` steps of a bucket are copied into the next bucket and the first
    ``ahead`` steps into the previous one as context rows. ``fn(frame, keys)`` runs
    its windows partitioned by (key, bucket); context rows are dropped afterwards.
    On a regular grid (one row per step, see ``regularize``) every lag/lead/frame
    reaching at most ``back`` rows back and ``ahead`` rows ahead gives exactly the
    per-key result, while one key's history spreads over many tasks.
    """
    if not (bucket_steps > back and bucket_steps > ahead):
        raise ValueError("bucket_steps must exceed the look-back and look-ahead")
    idx = F.floor(F.unix_seconds(F.col(ts)) / F.lit(step_seconds))
    b = F.floor(idx / F.lit(bucket_steps))
    pos = idx - b * F.lit(bucket_steps)
    cands = F.array(
        F.struct(b.alias("_bucket"), F.lit(False).alias("_ctx")),
        F.when(pos >= bucket_steps - back, F.struct((b + 1).alias("_bucket"), F.lit(True).alias("_ctx"))),
        F.when(pos < ahead, F.struct((b - 1).alias("_bucket"), F.lit(True).alias("_ctx"))),
    )
    expanded = df.select("*", F.inline(F.filter(cands, lambda x: x.isNotNull())))
    out = fn(expanded, [key, "_bucket"])
    return out.filter(~F.col("_ctx")).drop("_bucket", "_ctx")


def grid_features(hourly_df: DataFrame, key: str = KEY, ts: str = TS, limit: int = 6,
                  bucket_steps: int = 720) -> DataFrame:
    """Grid mode of the feature table: regular hourly grid, interpolation of short gaps,
    then full-window features computed on overlapping time buckets."""
    g = interpolate(regularize(hourly_df, key, ts), K.HOURLY_MEASURES, key, ts, limit)
    back = max(max(K.HOURLY_LAGS), max(n for n, _ in K.HOURLY_ROLLING), K.FORECAST_HORIZON_H + 1)
    return bucketed(g, lambda d, keys: hourly_features(d, keys, ts, notebook_mode=True), key, ts,
                    bucket_steps, back=back, ahead=K.FORECAST_HORIZON_H)
