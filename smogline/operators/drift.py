"""Drift of whole distributions, not of means only.

One table of (feature, value) with the rows of either side is the only thing made of the rows; it is aggregated map-side.

* Kolmogorov-Smirnov: the largest difference of the two cumulative shares over all values, by running counts from range
  partitions (no feature is ordered in one task), against the critical value of the two-sample test.
* Population stability: the baseline's quantiles cut both sides into bins; sum of (p - q) ln(p / q) over the bins' shares,
  where an empty bin counts as ``EMPTY``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.functions.columns import round_half
from smogline.operators.profile import exact_quantiles, running_counts
from smogline.session import stored

#: Coefficient of the critical value at the 5 % level, the usual alarm level of stability, share of an empty bin.
KS_COEFFICIENT = 1.358
PSI_ALARM = 0.2
EMPTY = 1e-4


def merged_counts(df: DataFrame, split: str, baseline: str, current: str, features: Sequence[str]) -> DataFrame:
    """(feature, value, base, now): rows per value on either side, as a written table."""
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]
    long = df.filter(F.col(split).isin(baseline, current)).select(split, F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    side = lambda name: F.count_if(F.col(split) == name)
    return stored(long.groupBy("feature", "value").agg(side(baseline).alias("base"), side(current).alias("now")), "merged-counts")


def distribution_drift(df: DataFrame, split: str, baseline: str, current: str, features: Sequence[str], bins: int = 10,
                       digits: int = 6) -> DataFrame:
    """Per feature: rows of both sides, ks, its critical value, psi, and whether either shows drift (null without rows on a
    side)."""
    merged = merged_counts(df, split, baseline, current, features)
    share = lambda c: (F.col(f"_before_{c}") + F.col(c)) / F.col(f"_n_{c}")
    sizes = merged.groupBy("feature").agg(F.sum("base").alias("n_baseline"), F.sum("now").alias("n_current"))
    both = sizes.filter("n_baseline > 0 AND n_current > 0")
    apart = (running_counts(merged.join(both, "feature", "left_semi"), ["feature"], "value", ["base", "now"])
             .groupBy("feature").agg(round_half(F.max(F.abs(share("base") - share("now"))), digits).alias("ks")))

    names = [f"e{i}" for i in range(1, bins)]
    rows = df.filter(F.col(split) == baseline).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])))
    edges = exact_quantiles(rows, ["feature"], "value", [i / bins for i in range(1, bins)], names)
    cuts = stored(edges.select("feature", F.array(*names).alias("cuts")), "stability-bins")  # one row a feature
    binned = merged.join(cuts, "feature").withColumn("bin", F.size(F.filter("cuts", lambda e: e < F.col("value"))))
    counts = binned.groupBy("feature", "bin").agg(F.sum("base").alias("base"), F.sum("now").alias("now"))
    every = both.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))  # an empty bin counts too
    full = every.join(counts, ["feature", "bin"], "left")
    p = F.greatest(F.coalesce("base", F.lit(0)) / F.col("n_baseline"), F.lit(EMPTY))
    q = F.greatest(F.coalesce("now", F.lit(0)) / F.col("n_current"), F.lit(EMPTY))
    stability = full.groupBy("feature").agg(round_half(F.sum((p - q) * F.log(p / q)), digits).alias("psi"))

    out = sizes.join(apart, "feature", "left").join(stability, "feature", "left")
    critical = KS_COEFFICIENT * F.sqrt((F.col("n_baseline") + F.col("n_current")) / (F.col("n_baseline") * F.col("n_current")))
    out = out.withColumn("ks_critical", F.when(F.col("ks").isNotNull(), round_half(critical, digits)))
    return out.withColumn("drift", (F.col("ks") > F.col("ks_critical")) | (F.col("psi") > PSI_ALARM))
