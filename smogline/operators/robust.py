"""Robust seasonal decomposition of daily series: local linear trends, weekday effects, and weights against outliers.

The series is put on a gap-free grid first (runs of missing steps are interpolated up to ``limit`` steps; what is still missing
stays a step without weight), so that a missing day shifts neither neighbourhoods nor phases. Then, for ``rounds`` rounds:

1. seasonal: the weighted mean of (value - trend) per phase, centred over the phases;
2. trend: at every step a straight line fitted to (value - seasonal) of the ``reach`` steps on either side, with tricube weights by
   distance times the robustness weights. The line's value comes from five moment sums over the window, so that ends of a
   series, and steps without weight, need no special case;
3. robustness: steps far off, measured by six medians of the absolute residuals of their key, lose weight (bisquare).

Every round is one window job and two small aggregates, and its rows are written once; results are rounded to 6 digits
in every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.columns import round_half
from smogline.operators.windows import KEY, TS, _w, interpolate, regularize
from smogline.session import stored

REACH, ROUNDS = 10, 3


def tricube(distance: int, reach: int) -> float:
    return (1 - (abs(distance) / (reach + 1)) ** 3) ** 3


def local_line(df: DataFrame, value: str, weight: str, name: str, reach: int = REACH, key: str = KEY, ts: str = TS) -> DataFrame:
    """``name``: at every row the value of a weighted line through the rows up to ``reach`` away (the weighted mean where a
    line is undefined; null without weight)."""
    w = _w(key, ts)
    df = df.withColumn("_wv", F.col(weight) * F.coalesce(F.col(value), F.lit(0.0)))
    near = range(-reach, reach + 1)
    at = lambda c, d: F.coalesce(F.lead(c, d).over(w) if d > 0 else F.lag(c, -d).over(w) if d else F.col(c), F.lit(0.0))
    df = df.withColumns({f"_{c}{i}": at(s, d) * F.lit(tricube(d, reach)) for i, d in enumerate(near) for c, s in (("a", weight), ("b", "_wv"))})

    def moment(c: str, power: int):
        total = F.lit(0.0)
        for i, d in enumerate(near):
            if not power or d:
                total = total + (F.col(f"_{c}{i}") * F.lit(float(d ** power)) if power else F.col(f"_{c}{i}"))
        return total

    df = df.withColumns({"_s0": moment("a", 0), "_s1": moment("a", 1), "_s2": moment("a", 2), "_t0": moment("b", 0), "_t1": moment("b", 1)})
    s0, s1, s2, t0, t1 = (F.col(c) for c in ("_s0", "_s1", "_s2", "_t0", "_t1"))
    det = s0 * s2 - s1 * s1
    line = F.when(det > 1e-6 * s0 * s0, (t0 * s2 - t1 * s1) / F.when(det > 1e-6 * s0 * s0, det)).otherwise(F.try_divide(t0, F.nullif(s0, F.lit(0.0))))
    helpers = [f"_{c}{i}" for i in range(len(near)) for c in "ab"] + ["_wv", "_s0", "_s1", "_s2", "_t0", "_t1"]
    return df.withColumn(name, round_half(line, 6)).drop(*helpers)


def robust_decompose(df: DataFrame, col: str = "aqi", period: int = 7, reach: int = REACH, rounds: int = ROUNDS, step: str = "1 day",
                     limit: int = 5, key: str = KEY, ts: str = TS) -> DataFrame:
    """(key, time, value, trend, seasonal, resid, weight) of every step with a value."""
    grid = interpolate(regularize(df.select(key, ts, col), key, ts, step), [col], key, ts, limit)
    rows = grid.select(key, ts, col, ((F.row_number().over(_w(key, ts)) - 1) % period).alias("_phase"))
    known = F.col(col).isNotNull()
    rows = rows.withColumn("weight", F.when(known, 1.0).otherwise(0.0))
    rows = stored(local_line(rows, col, "weight", "trend", reach, key, ts), "trend")  # each round reads it twice
    for _ in range(rounds):
        off = F.col("weight") * (F.col(col) - F.col("trend"))
        phases = rows.groupBy(key, "_phase").agg(round_half(F.try_divide(F.sum(off), F.nullif(F.sum("weight"), F.lit(0.0))), 6).alias("_mean"))
        phases = phases.select(F.col(key).alias("_key"), F.col("_phase").alias("_of"), round_half(
            F.coalesce("_mean", F.lit(0.0)) - F.avg(F.coalesce("_mean", F.lit(0.0))).over(Window.partitionBy(key)), 6).alias("seasonal"))
        rows = rows.drop("seasonal", "trend").join(phases, rows[key].eqNullSafe(phases["_key"]) & (rows["_phase"] == phases["_of"])).drop("_key", "_of")
        rows = rows.withColumn("_plain", F.col(col) - F.col("seasonal"))
        rows = local_line(rows, "_plain", "weight", "trend", reach, key, ts).drop("_plain")
        rows = stored(rows.withColumn("resid", round_half(F.col(col) - F.col("trend") - F.col("seasonal"), 6)), "trend")
        scale = rows.groupBy(F.col(key).alias("_key")).agg((F.lit(6.0) * F.median(F.abs("resid"))).alias("_scale"))
        rows = rows.join(scale, rows[key].eqNullSafe(scale["_key"]), "left").drop("_key")
        share = F.abs(F.col("resid")) / F.nullif(F.col("_scale"), F.lit(0.0))
        bisquare = F.when(share.isNull(), 1.0).when(share >= 1, 0.0).otherwise(F.pow(1 - share * share, F.lit(2.0)))
        rows = rows.withColumn("weight", F.when(known, round_half(bisquare, 6)).otherwise(0.0)).drop("_scale")
    return rows.filter(known).select(key, ts, col, "trend", "seasonal", "resid", "weight")
