"""Machine-learning data operators: encodings, splits, metrics, baselines, scaling, reports.

Fitted state (code tables, scaler statistics, thresholds) is either a small
DataFrame joined back, or a handful of numbers returned by one aggregate action,
as Spark ML estimators do; row data never passes through the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.columns import exact_avg, round_half


# --- M1: category codes --------------------------------------------------------
def fit_codes(df: DataFrame, col: str, code: str = "city_code") -> DataFrame:
    """Code table: distinct values numbered 0.. in sorted order (one small aggregate)."""
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return d.withColumn(code, (F.dense_rank().over(Window.orderBy(col)) - 1).cast("int"))


def apply_codes(df: DataFrame, table: DataFrame, col: str, code: str = "city_code") -> DataFrame:
    """Attach codes; values unseen at fit time get -1. AQE broadcasts the table when it is small."""
    return df.join(table, col, "left").withColumn(code, F.coalesce(F.col(code), F.lit(-1)))


# --- M2/M3: training rows and time split ------------------------------------------
def training_rows(df: DataFrame, target: str, exclude: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Drop null targets, then rows with a null feature; features = all columns but ``exclude``."""
    feats = [c for c in df.columns if c not in set(exclude) | {target}]
    return df.na.drop(subset=[target]).na.drop(subset=feats), feats


def time_split(df: DataFrame, train_end: str | dt.datetime, val_end: str | dt.datetime,
               ts: str = "measured_at", name: str = "split") -> DataFrame:
    t = F.col(ts)
    a, b = F.lit(train_end).cast("timestamp"), F.lit(val_end).cast("timestamp")
    return df.withColumn(name, F.when(t < a, "train").when(t < b, "val").when(t.isNotNull(), "test"))


def check_splits(split_counts: DataFrame, name: str = "split") -> None:
    """Raise when a split is empty (one tiny aggregate action)."""
    present = {r[name] for r in split_counts.select(name).distinct().collect()}
    missing = {"train", "val", "test"} - present
    if missing:
        raise RuntimeError(f"empty split(s): {sorted(missing)}; check the split dates against the data")


# --- M5-M7: metrics -------------------------------------------------------------
def metric_columns(y: str | Column, p: str | Column, digits: int = 6) -> list[Column]:
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    ok = y.isNotNull() & p.isNotNull()
    e = F.when(ok, y - p)
    return [
        round_half(F.avg(F.abs(e)), digits).alias("mae"),
        round_half(F.sqrt(F.avg(e * e)), digits).alias("rmse"),
        round_half(F.avg(F.abs(e / (y + F.lit(1e-6)))) * F.lit(100.0), digits).alias("mape"),
        F.count(e).alias("n"),
    ]


def evaluate(df: DataFrame, target: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(*metric_columns(target, prediction))


def baseline_metrics(df: DataFrame, target: str, baselines: Mapping[str, str]) -> DataFrame:
    """Score several prediction columns at once: unpivot (name, prediction), group by name."""
    long = df.select(F.col(target).alias("_y"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(c).cast("double").alias("_p")) for n, c in baselines.items()])))
    return long.groupBy("name").agg(*metric_columns("_y", "_p"))


def city_errors(df: DataFrame, target: str, prediction: str, key: str = "queried_city") -> DataFrame:
    e = F.col(target) - F.col(prediction)
    ok = F.col(target).isNotNull() & F.col(prediction).isNotNull()
    return df.where(ok).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), round_half(F.avg(F.abs(e)), 6).alias("mae"),
        round_half(F.sqrt(F.avg(e * e)), 6).alias("rmse"), exact_avg(target).alias("mean_target"))


def approval(metrics: DataFrame, threshold: float, mae: str = "mae") -> DataFrame:
    return metrics.withColumn("status", F.when(F.col(mae) <= threshold, "Approved").otherwise("PendingManualApproval"))


# --- M9: standard scaling (population std) -------------------------------------
def fit_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column from one aggregate (2 numbers per column)."""
    row = train.agg(*[x for c in cols for x in (exact_avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_scaler(df: DataFrame, stats: Mapping[str, tuple[float, float]], digits: int = 6,
                 suffix: str = "_z") -> DataFrame:
    return df.withColumns({
        f"{c}{suffix}": round_half(F.try_divide(F.col(c) - F.lit(m), F.nullif(F.lit(s), F.lit(0.0))), digits)
        for c, (m, s) in stats.items()})


# --- anomaly reports on any flag/score columns -----------------------------------
def flag_kpis(df: DataFrame, flag: str, value: str = "aqi", alert_above: float = 150.0) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(flag).cast("long").alias("anomalies"),
        (F.avg(flag) * F.lit(100.0)).alias("anomaly_rate_pct"),
        F.count_if((F.col(flag) == 1) & (F.col(value) > alert_above)).alias("severe_anomalies"))


def alerts(df: DataFrame, flag: str, value: str = "aqi", above: float = 150.0) -> DataFrame:
    """Rows that are flagged and above the AQI alert level; keys travel with the rows."""
    return df.filter((F.col(flag) == 1) & (F.col(value) > above))


def top_k(df: DataFrame, score: str, k: int, keys: Sequence[str], per: str | None = None,
          salt_buckets: int = 32) -> DataFrame:
    """Top-k rows by score (desc, keys asc as tie-break), globally or per group.

    Global: TakeOrdered (each task keeps k rows). Per group: exact two-phase ranking -
    rows are first ranked inside (group, salt) buckets keyed by a hash of the row keys,
    keeping k per bucket, then the <= salt_buckets * k survivors are ranked per group,
    so a group holding a third of all rows is spread over ``salt_buckets`` tasks.
    """
    order = [F.col(score).desc_nulls_last()] + [F.col(c) for c in keys]
    if per is None:
        return df.orderBy(*order).limit(k)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(salt_buckets)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy(per, "_salt").orderBy(*order)))
    cand = first.filter(F.col("_r") <= k).drop("_r", "_salt")
    w = Window.partitionBy(per).orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def monthly_counts(df: DataFrame, flag: str, key: str = "queried_city", ts: str = "measured_at") -> DataFrame:
    """Flag count per (key, year, month) with all 12 months present (missing -> 0)."""
    counts = df.groupBy(key, F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.sum(flag).cast("long").alias("n_anomalies"))
    years = df.groupBy(key, F.year(ts).alias("year")).agg(F.lit(1).alias("_x"))
    cal = years.select(key, "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return cal.join(counts, [key, "year", "month"], "left").select(
        key, "year", "month", F.coalesce("n_anomalies", F.lit(0)).alias("n_anomalies"))


def seasonal_rate(df: DataFrame, flag: str, key_value: str, months: Mapping[str, Sequence[int]],
                  key: str = "queried_city", ts: str = "measured_at") -> DataFrame:
    """Flag rate in % for named month sets of one key value (e.g. winter vs summer)."""
    season = None
    for name, ms in months.items():
        cond = F.month(ts).isin(*ms)
        season = F.when(cond, F.lit(name)) if season is None else season.when(cond, F.lit(name))
    f = df.filter(F.col(key) == key_value).withColumn("season", season).filter(F.col("season").isNotNull())
    return f.groupBy("season").agg(F.count(F.lit(1)).alias("n"), (F.avg(flag) * F.lit(100.0)).alias("rate_pct"))


def agreement(df: DataFrame, flag_a: str, flag_b: str, a: str = "z", b: str = "if") -> DataFrame:
    """Category counts/shares (both, a_only, b_only, normal); see ``overlap`` for the precisions."""
    fa, fb = F.coalesce(F.col(flag_a), F.lit(0)), F.coalesce(F.col(flag_b), F.lit(0))
    cat = F.when((fa == 1) & (fb == 1), "both").when(fa == 1, f"{a}_only").when(fb == 1, f"{b}_only").otherwise("normal")
    c = df.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share_pct", F.col("n") / F.sum("n").over(Window.partitionBy()) * F.lit(100.0))


def overlap(df: DataFrame, flag_a: str, flag_b: str) -> DataFrame:
    """One row: rows flagged by each detector and by both, and the shares both/a and both/b (null without flags)."""
    a, b = F.coalesce(F.col(flag_a), F.lit(0)) == 1, F.coalesce(F.col(flag_b), F.lit(0)) == 1
    n = df.agg(F.count_if(a).alias("n_a"), F.count_if(b).alias("n_b"), F.count_if(a & b).alias("n_both"))
    return n.withColumns({"share_of_a": F.try_divide("n_both", "n_a"), "share_of_b": F.try_divide("n_both", "n_b")})


def rate_by(df: DataFrame, flag: str, key: str = "queried_city") -> DataFrame:
    """Flagged rows and their rate in % per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(flag).cast("long").alias("n_anomalies"),
                               (F.avg(flag) * F.lit(100.0)).alias("rate_pct"))


# --- M11: input checks before scoring ---------------------------------------------
def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fail on the driver, before any job, when feature columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df


# --- T5k: repeatable sample ------------------------------------------------------
def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash of the keys' text: the same rows for any partitioning, and in any engine
    with md5 (TakeOrdered: each task keeps at most ``n`` candidates)."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text.cast("binary")), *keys).limit(n)


# --- M21: drift watch ------------------------------------------------------------
def drift(df: DataFrame, split: str, baseline: str, current: str, metrics: Mapping[str, Column],
          threshold_pct: float = 50.0, digits: int = 6) -> DataFrame:
    """Per metric: baseline vs current value (one pass, conditional aggregates), relative
    change in % and a drift flag when |change| exceeds ``threshold_pct``."""
    aggs = []
    for name, expr in metrics.items():
        aggs.append(F.avg(F.when(F.col(split) == baseline, expr)).alias(f"b_{name}"))
        aggs.append(F.avg(F.when(F.col(split) == current, expr)).alias(f"c_{name}"))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("metric"), round_half(F.col(f"b_{n}"), digits).alias("baseline"),
                     round_half(F.col(f"c_{n}"), digits).alias("current")) for n in metrics]
    long = wide.select(F.inline(F.array(*rows)))
    change = round_half(F.try_divide(F.col("current") - F.col("baseline"), F.col("baseline")) * F.lit(100.0), digits)
    return long.withColumn("change_pct", change).withColumn("drift", F.abs(F.col("change_pct")) > threshold_pct)
