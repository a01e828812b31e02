"""Profiling and analysis aggregates (the notebook/dashboard tables, as Spark jobs).

Exact quantiles are a selection in two passes. The first keeps one mergeable quantile sketch per key, whose rank error is
known, so that it gives an interval per probability that surely holds the wanted order statistics. The second
counts the rows below each interval and the rows per value inside; only these few values are ever ordered. Both passes
aggregate map-side: raw rows are neither shuffled nor sorted.

Ranks of all values (``running_count``) come from a range partitioning: each partition counts its rows, prefix sums over the
partitions of a key give the rows before, and only the rows of one partition are ever ordered in one task. Partitions
hold about equally many distinct values, however they are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.functions.columns import exact_avg, round_half
from smogline.session import stored


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing share in % per column, one pass, returned long: (column, missing_pct)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * F.lit(100.0)).alias(c) for c in cols])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("missing_pct")) for c in cols]
    return wide.select(F.inline(F.array(*pairs)))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys..., value, _c): rows per distinct non-null value (map-side partial aggregation)."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))


def running_counts(vc: DataFrame, keys: Sequence[str], value: str, counts: Sequence[str], partitions: int | None = None) -> DataFrame:
    """A table with one row per (key, value) and, for every count column c, ``_before_c`` (its sum over the key's smaller
    values) and ``_n_c`` (its sum over the key). Null keys are keys."""
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)
    n = partitions or int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (vc.withColumn("_key", key).repartitionByRange(n, "_key", value).sortWithinPartitions("_key", value)
              .withColumn("_piece", F.shiftright(F.monotonically_increasing_id(), 33)))
    ranged = stored(ranged, "value-ranges")  # read twice below
    by_key = Window.partitionBy("_key")
    earlier = by_key.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = ranged.groupBy("_key", "_piece").agg(*[F.sum(c).alias(f"_rows_{c}") for c in counts])
    pieces = pieces.select("_key", "_piece", *[
        x for c in counts for x in (F.coalesce(F.sum(f"_rows_{c}").over(earlier), F.lit(0)).alias(f"_skip_{c}"),
                                    F.sum(f"_rows_{c}").over(by_key).alias(f"_n_{c}"))])
    smaller = Window.partitionBy("_key", "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(smaller), F.lit(0)) for c in counts})
    joined = placed.join(pieces, ["_key", "_piece"])
    return joined.withColumns({f"_before_{c}": F.col(f"_skip_{c}") + F.col(f"_in_{c}") for c in counts}).drop(
        "_key", "_piece", *[f"{x}_{c}" for c in counts for x in ("_skip", "_in")])


def running_count(vc: DataFrame, keys: Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """A value-count table with ``_before`` (rows of the key with a smaller value) and ``_n`` (rows of the key)."""
    return running_counts(vc, keys, value, ["_c"], partitions).withColumnsRenamed({"_before__c": "_before", "_n__c": "_n"})


#: Rank error of the first pass' sketch, as one part in so many of a key's rows.
ACCURACY = 20_000
#: Keys with fewer rows than ACCURACY have exact sketches; from this many rows on, the interval is this share on either side.
SMALL, SMALL_SHARE = 200, 0.01


def quantile_intervals(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                       accuracy: int = ACCURACY) -> DataFrame:
    """(keys..., _n, _at): per key its rows, and per probability (p, low, high), values that the order statistics around the
    quantile surely lie between."""
    points = sorted({0.0, 1.0, *(min(1.0, max(0.0, p + s)) for p in probs for s in
                                 (-2 / accuracy, 2 / accuracy, -SMALL_SHARE, SMALL_SHARE))})
    at = {p: i for i, p in enumerate(points)}

    def edge(p: float, sign: int) -> Column:
        inside = lambda share: F.col("_points")[at[min(1.0, max(0.0, p + sign * share))]]
        return (F.when(F.col("_n") >= accuracy, inside(2 / accuracy)).when(F.col("_n") >= SMALL, inside(SMALL_SHARE))
                .otherwise(F.col("_points")[at[0.0 if sign < 0 else 1.0]]))

    found = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(value, points, accuracy).alias("_points"))
    return found.filter("_n > 0").select(*keys, "_n", F.array(*[
        F.struct(F.lit(i).alias("i"), edge(p, -1).alias("low"), edge(p, 1).alias("high")) for i, p in enumerate(probs)]).alias("_at"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, digits: int | None = 6, accuracy: int = ACCURACY) -> DataFrame:
    """Exact linear-interpolated quantiles per key (pandas/SQL ``quantile_cont``); rounded unless ``digits`` is None."""
    keys, names = list(keys), list(names or [f"q{int(round(p * 100))}" for p in probs])
    intervals = stored(quantile_intervals(df, keys, value, probs, accuracy), "quantile-intervals")  # broadcast if small
    rows, v = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v")), F.col("_v")
    if keys:
        there = intervals.select(*[F.col(k).alias(f"_{k}") for k in keys], "_n", "_at")
        rows = rows.join(there, [rows[k].eqNullSafe(there[f"_{k}"]) for k in keys])
    else:
        one = intervals.first()  # the only row, as literals
        if one is None:
            return df.agg(*[F.max(F.lit(None).cast("double")).alias(name) for name in names])
        at = F.array(*[F.struct(*[F.lit(a[c]).alias(c) for c in ("i", "low", "high")]) for a in one["_at"]])
        rows = rows.select("_v", F.lit(one["_n"]).alias("_n"), at.alias("_at"))
    each = rows.select(*keys, "_n", "_v", F.explode("_at").alias("_at")).filter(v <= F.col("_at.high"))
    each = each.select(*keys, "_n", F.col("_at.i").alias("_i"), F.when(v >= F.col("_at.low"), v).alias("_v"))  # null: below
    counted = each.groupBy(*keys, "_n", "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    so_far = Window.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_v"))
    upto = F.sum("_c").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.withColumn("_upto", upto).filter("_v IS NOT NULL")
    result: list[Column] = []
    for i, (p, name) in enumerate(zip(probs, names, strict=True)):
        mine, pos = F.col("_i") == i, (F.col("_n") - 1) * F.lit(float(p))

        def at_rank(rank: Column, mine: Column = mine) -> Column:
            here = (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
            return F.max(F.when(mine & here, F.col("_v")))

        lower, upper = at_rank(F.floor(pos)), at_rank(F.ceil(pos))
        share = F.max(F.when(mine, pos - F.floor(pos)))
        quantile = lower + (upper - lower) * share
        quantile = F.when(lower.isNull() | upper.isNull(), F.raise_error(F.lit(f"no interval for {name}")).cast("double")).otherwise(quantile)
        result.append((quantile if digits is None else round_half(quantile, digits)).alias(name))
    return ranked.groupBy(*keys).agg(*result)


def city_stats(df: DataFrame, key: str = "queried_city", value: str = "aqi", threshold: float = 100.0) -> DataFrame:
    """count, mean, median, std, min, max, share above ``threshold`` in % per key."""
    base = df.groupBy(key).agg(
        F.count(value).alias("count"),
        exact_avg(value).alias("mean"),
        round_half(F.stddev(value), 6).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.avg((F.col(value) > threshold).cast("int")) * F.lit(100.0)).alias(f"pct_above_{int(threshold)}"),
    )
    med = exact_quantiles(df, [key], value, [0.5], ["median"])
    return base.join(med, key, "left")


def box_stats(df: DataFrame, key: str = "queried_city", value: str = "aqi") -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (extreme values inside the fences), outlier count.

    The quartiles take two passes and the rest a third one, in which the rows meet the fences of their key.
    """
    q = exact_quantiles(df, [key], value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lower_fence", F.col("q1") - F.lit(1.5) * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * F.col("iqr"))
    q = stored(q, "fences")  # broadcast if small
    v = F.col(value)
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    fences = q.select(F.col(key).alias("_key"), "lower_fence", "upper_fence")
    agg = df.join(fences, F.col(key).eqNullSafe(F.col("_key"))).groupBy(key).agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(v.isNotNull() & ~inside).alias("n_outliers"),
    )
    return q.join(agg, q[key].eqNullSafe(agg[key]), "left").drop(agg[key])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per numeric column, one row per column.

    The columns are unpivoted once (narrow ``inline``) so every statistic of every
    column comes from one scan and one pre-aggregated shuffle keyed by column name.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                        for c in cols])))
    s = long.groupBy("column").agg(F.count("v").alias("count"), exact_avg("v").alias("mean"),
                                   round_half(F.stddev("v"), 6).alias("std"), F.min("v").alias("min"),
                                   F.max("v").alias("max"))
    q = exact_quantiles(long, ["column"], "v", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return s.join(q, "column", "left")


def profile_by(df: DataFrame, keys: Sequence[str | Column], value: str = "aqi") -> DataFrame:
    return df.groupBy(*keys).agg(exact_avg(value).alias(f"avg_{value}"), F.count(value).alias("n"))


def pivot_mean(df: DataFrame, row: str | Column, col: str, values: Sequence, value: str = "aqi",
               other: str | None = None) -> DataFrame:
    """Row x column table of means with the column values given (no discovery job). Rows of further values (and of null)
    count in the column ``other``, if one is named; else only their rows' labels show."""
    if other is not None:
        known = F.coalesce(F.col(col).isin(*values), F.lit(False))
        df, values = df.withColumn(col, F.when(known, F.col(col)).otherwise(F.lit(other))), [*values, other]
    return df.groupBy(row).pivot(col, list(values)).agg(exact_avg(value))


def share_within(df: DataFrame, key: str, category: str) -> DataFrame:
    """Row count per (key, category) and its share in % of the key's rows."""
    c = df.groupBy(key, category).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share_pct", F.col("n") / F.sum("n").over(Window.partitionBy(key)) * F.lit(100.0))


def latest_non_null(df: DataFrame, key: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the value of each column at the latest ordering among its non-null rows."""
    ordering = F.struct(*[F.col(o) for o in order])
    return df.groupBy(key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in cols])


def histogram(df: DataFrame, value: str, width: float, keys: Sequence[str] = ()) -> DataFrame:
    b = (F.floor(F.col(value) / F.lit(width)) * F.lit(width)).alias("bin_start")
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, b).agg(F.count(F.lit(1)).alias("n"))
