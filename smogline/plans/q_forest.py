"""A stored isolation forest: saved, loaded and scored in Spark; the oracle walks the same node table in SQL.

The forest is grown by a rule (seeded sample and splits), so both engines hold the same nodes. Scores are rounded to 6 digits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from smogline import constants as K
from smogline.functions.columns import round_half
from smogline.operators import iforest, ml, profile
from smogline.operators import windows as W
from smogline.operators.forest_model import IsolationForestModel
from smogline.plans.q_ml import _SEASONS, _Z_SQL, _zscored
from smogline.plans.registry import query
from smogline.plans.sql_views import YEARLY, r6, with_views, xavg
from smogline.session import scratch_path
from smogline.sources.testdata import yearly_readings

FEATURES = ["aqi", "pm25"]
TREES, SAMPLES, THRESHOLD = 12, 64, 0.62


def stored_nodes() -> pd.DataFrame:
    """The node table of a forest over two normal features (mean 50, deviation 10), 100 rows."""
    sample = np.random.default_rng(42).normal(50, 10, (100, 2))
    rows = []
    for tree in range(TREES):
        rng = np.random.default_rng([42, tree])
        drawn = sample[rng.choice(len(sample), SAMPLES, replace=False)]
        rows += [(tree, *node) for node in iforest._grow(drawn, rng, 6)]
    return pd.DataFrame(rows, columns=["tree_id", "node_id", "feature", "threshold", "left", "right", "size"]).astype(
        {c: "int32" for c in ("tree_id", "node_id", "feature", "left", "right", "size")})


def stored_model(spark) -> IsolationForestModel:
    """The forest, written and loaded again."""
    model = IsolationForestModel(stored_nodes(), SAMPLES, {}, THRESHOLD)
    model._set(features=FEATURES, keys=["queried_city", "measured_at"])
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    return IsolationForestModel.load(path)


def _walk_sql(views: str, source: str, keep: str) -> str:
    """``views`` and ``scored``: the rows of ``source`` with both features, their score and flag."""
    nodes = ", ".join(f"({n.tree_id}, {n.node_id}, {n.feature}, CAST({n.threshold!r} AS DOUBLE), {n.left}, {n.right}, "
                      f"CAST({float(iforest.c_factor([n.size])[0])!r} AS DOUBLE))" for n in stored_nodes().itertuples())
    return views.replace("WITH", "WITH RECURSIVE", 1) + f""",
nodes(tree, node, feature, threshold, lft, rgt, adjust) AS (VALUES {nodes}),
walk AS (
  SELECT {keep}, aqi AS x0, pm25 AS x1, tree, 0 AS node, 0 AS depth
  FROM {source}, (SELECT DISTINCT tree FROM nodes) t WHERE aqi IS NOT NULL AND pm25 IS NOT NULL
  UNION ALL
  SELECT {', '.join('w.' + c.strip() for c in keep.split(','))}, x0, x1, w.tree,
    CASE WHEN (CASE feature WHEN 0 THEN x0 ELSE x1 END) < threshold THEN lft ELSE rgt END, depth + 1
  FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE n.feature >= 0),
scored0 AS (
  SELECT {keep}, {r6(f"power(2.0, -avg(depth + adjust) / CAST({float(iforest.c_factor([SAMPLES])[0])!r} AS DOUBLE))")} AS iforest_score
  FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE n.feature < 0 GROUP BY ALL),
scored AS (SELECT *, CASE WHEN iforest_score > {THRESHOLD} THEN 1 ELSE 0 END AS is_anom_iforest FROM scored0)"""


_HOURS = _walk_sql(_Z_SQL, "z", "queried_city, measured_at, aqi, zscore_7d, is_anom_zscore")


def _scored_hours(spark, sf_dir):
    hours = _zscored(spark, sf_dir).select("queried_city", "measured_at", "aqi", "pm25", "zscore_7d", "is_anom_zscore")
    return _flagged(stored_model(spark).transform(hours.na.drop(subset=FEATURES)))


def _flagged(scored):
    scored = scored.withColumn("iforest_score", round_half("iforest_score", 6))
    return scored.withColumn("is_anom_iforest", (F.col("iforest_score") > THRESHOLD).cast("int"))


@query("forest_stored_scores", _HOURS + "\nSELECT queried_city, measured_at, aqi, iforest_score, is_anom_iforest FROM scored")
def q_forest_stored_scores(spark, sf_dir):
    """Every hour's score by the loaded model."""
    return _scored_hours(spark, sf_dir).select("queried_city", "measured_at", "aqi", "iforest_score", "is_anom_iforest")


@query("forest_stored_agreement", _HOURS + """,
c AS (SELECT CASE WHEN coalesce(is_anom_zscore, 0) = 1 AND is_anom_iforest = 1 THEN 'both' WHEN coalesce(is_anom_zscore, 0) = 1 THEN 'z_only'
             WHEN is_anom_iforest = 1 THEN 'if_only' ELSE 'normal' END AS category FROM scored)
SELECT category, COUNT(*) AS n, COUNT(*) / SUM(COUNT(*)) OVER () * 100.0 AS share_pct FROM c GROUP BY 1""")
def q_forest_stored_agreement(spark, sf_dir):
    """Hours flagged by the z-score, the forest, both or none."""
    return ml.agreement(_scored_hours(spark, sf_dir), "is_anom_zscore", "is_anom_iforest")


@query("forest_stored_overlap", _HOURS + """,
n AS (SELECT COUNT(*) FILTER (is_anom_zscore = 1) AS n_a, COUNT(*) FILTER (is_anom_iforest = 1) AS n_b,
        COUNT(*) FILTER (is_anom_zscore = 1 AND is_anom_iforest = 1) AS n_both FROM scored)
SELECT *, n_both / NULLIF(n_a, 0) AS share_of_a, n_both / NULLIF(n_b, 0) AS share_of_b FROM n""")
def q_forest_stored_overlap(spark, sf_dir):
    """How much of each detector's flags the other one shares."""
    return ml.overlap(_scored_hours(spark, sf_dir), "is_anom_zscore", "is_anom_iforest")


@query("forest_stored_sweep", _HOURS + ",\n" + f"""
t AS ({' UNION ALL '.join(f"SELECT CAST({r!r} AS DOUBLE) AS contamination, {r6(f'quantile_cont(iforest_score, {1 - r!r})')} AS threshold FROM scored" for r in K.CONTAMINATION_SWEEP)})
SELECT contamination, threshold, COUNT(*) FILTER (iforest_score > threshold) AS n_flagged,
  COUNT(*) FILTER (iforest_score > threshold AND is_anom_zscore = 1) AS overlap_with_zscore
FROM t, scored GROUP BY 1, 2""")
def q_forest_stored_sweep(spark, sf_dir):
    """Flags at several contamination rates: exact quantiles of the stored forest's scores as thresholds."""
    scored = _scored_hours(spark, sf_dir).persist()
    rates = list(K.CONTAMINATION_SWEEP)
    cuts = profile.exact_quantiles(scored, [], "iforest_score", [1 - r for r in rates], [f"t{i}" for i in range(len(rates))]).first()
    hit = [F.col("iforest_score") > F.lit(cuts[i]) for i in range(len(rates))]
    z = F.coalesce(F.col("is_anom_zscore"), F.lit(0)) == 1
    wide = scored.agg(*[a for i in range(len(rates)) for a in (F.count_if(hit[i]).alias(f"n{i}"), F.count_if(hit[i] & z).alias(f"o{i}"))])
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(float(r)).alias("contamination"), F.lit(cuts[i]).alias("threshold"), F.col(f"n{i}").alias("n_flagged"),
        F.col(f"o{i}").alias("overlap_with_zscore")) for i, r in enumerate(rates)])))


_SEASON_CASE = "CASE " + " ".join(f"WHEN month(measured_at) IN ({', '.join(map(str, ms))}) THEN '{n}'" for n, ms in _SEASONS.items()) + " END"


@query("forest_stored_seasons", _walk_sql(with_views(YEARLY, f"""
d AS (SELECT queried_city, date_trunc('day', measured_at) AS measured_at, {xavg('aqi')} AS aqi, {xavg('pm25')} AS pm25
      FROM yearly GROUP BY 1, 2)"""), "d", "queried_city, measured_at, aqi") + f"""
SELECT {_SEASON_CASE} AS season, COUNT(*) AS n, AVG(is_anom_iforest) * 100.0 AS rate_pct
FROM scored WHERE queried_city = 'ha-noi' AND {_SEASON_CASE} IS NOT NULL GROUP BY 1""")
def q_forest_stored_seasons(spark, sf_dir):
    """Winter against summer: the rate of flagged days of one city over the years."""
    days = W.daily_means(yearly_readings(spark, sf_dir), measures=FEATURES)
    return ml.seasonal_rate(_flagged(stored_model(spark).transform(days)), "is_anom_iforest", "ha-noi", _SEASONS)
