"""Drift of distributions, outputs attached by position, neighbour-based mutual information."""

from __future__ import annotations

from pyspark.sql import functions as F

from smogline.operators import ml
from smogline.operators import windows as W
from smogline.operators.attach import attach_by_position
from smogline.operators.drift import EMPTY, KS_COEFFICIENT, PSI_ALARM, distribution_drift
from smogline.operators.neighbours import neighbour_mutual_info
from smogline.plans.q_ml import TRAIN_END, VAL_END
from smogline.plans.registry import query
from smogline.plans.sql_views import READINGS, hourly_cte, r6, with_views
from smogline.session import scratch_path
from smogline.sources.testdata import readings

_FEATURES = ["aqi", "pm10", "humidity", "aqi_wider"]
_QUANTILES = ", ".join(f"{r6(f'quantile_cont(value, {i / 10})')}" for i in range(1, 10))

_BIN = " + ".join(f"CAST(cuts[{i}] < value AS INTEGER)" for i in range(1, 10))


@query("distribution_drift", with_views(READINGS, hourly_cte(), f"""
s AS (SELECT *, CASE WHEN measured_at < TIMESTAMP '{TRAIN_END}' THEN 'base' WHEN measured_at >= TIMESTAMP '{VAL_END}' THEN 'now' END AS side,
        CASE WHEN measured_at >= TIMESTAMP '{VAL_END}' THEN 245 + (aqi - 245) * 1.5 ELSE aqi END AS aqi_wider FROM h),
l AS ({' UNION ALL '.join(f"SELECT side, '{c}' AS feature, {c} AS value FROM s WHERE side IS NOT NULL AND {c} IS NOT NULL" for c in _FEATURES)}),
m AS (SELECT feature, value, COUNT(*) FILTER (side = 'base') AS base, COUNT(*) FILTER (side = 'now') AS now FROM l GROUP BY 1, 2),
z AS (SELECT feature, SUM(base) AS nb, SUM(now) AS nn FROM m GROUP BY 1),
k AS (SELECT feature, MAX(abs(b / nb - c / nn)) AS ks FROM (
        SELECT feature, nb, nn, SUM(base) OVER w AS b, SUM(now) OVER w AS c FROM m JOIN z USING (feature)
        WINDOW w AS (PARTITION BY feature ORDER BY value)) x GROUP BY 1),
e AS (SELECT feature, [{_QUANTILES}] AS cuts FROM l WHERE side = 'base' GROUP BY 1),
b AS (SELECT feature, {_BIN} AS bin, SUM(base) AS base, SUM(now) AS now FROM m JOIN e USING (feature) GROUP BY 1, 2),
f AS (SELECT z.feature, greatest(coalesce(base, 0) / nb, {EMPTY}) AS p, greatest(coalesce(now, 0) / nn, {EMPTY}) AS q
      FROM (SELECT *, unnest(range(0, 10)) AS bin FROM z) z LEFT JOIN b ON z.feature = b.feature AND z.bin = b.bin),
t AS (SELECT feature, SUM((p - q) * ln(p / q)) AS psi FROM f GROUP BY 1),
r AS (SELECT feature, CAST(nb AS BIGINT) AS n_baseline, CAST(nn AS BIGINT) AS n_current, {r6('ks')} AS ks, {r6('psi')} AS psi,
        {r6(f'{KS_COEFFICIENT} * sqrt((nb + nn) / (nb * nn))')} AS ks_critical FROM z JOIN k USING (feature) JOIN t USING (feature))""") + f"""
SELECT *, ks > ks_critical OR psi > {PSI_ALARM} AS drift FROM r""")
def q_distribution_drift(spark, sf_dir):
    """Training weeks against the last days; ``aqi_wider`` keeps its centre and spreads."""
    h = ml.time_split(W.hourly(readings(spark, sf_dir)), TRAIN_END, VAL_END)
    wider = F.when(F.col("split") == "test", 245 + (F.col("aqi") - 245) * 1.5).otherwise(F.col("aqi"))
    return distribution_drift(h.withColumn("aqi_wider", wider), "split", "train", "test", _FEATURES)


@query("attach_predictions", with_views(READINGS, hourly_cte()) + f"""
SELECT queried_city, measured_at, aqi, {r6('aqi * 1.1')} AS predicted_aqi FROM h""")
def q_attach_predictions(spark, sf_dir):
    """Features in Parquet parts, predictions without keys in as many CSV parts as another job wrote: row by row."""
    root = scratch_path(spark, "attach")
    h = W.hourly(readings(spark, sf_dir)).select("queried_city", "measured_at", "aqi")
    order = ["queried_city", "measured_at"]
    h.repartitionByRange(5, *order).sortWithinPartitions(*order).write.parquet(f"{root}/features")
    out = h.repartitionByRange(3, *order).sortWithinPartitions(*order)
    out.select(F.round(F.col("aqi") * 1.1 + 1e-9, 6).alias("predicted_aqi")).write.csv(f"{root}/predictions")
    return attach_by_position(spark.read.parquet(f"{root}/features"),
                              spark.read.schema("predicted_aqi double").csv(f"{root}/predictions"))


_MI_FEATURES = ["pm10", "humidity", "temperature", "wind"]
_STEP = "CAST(CAST(epoch(measured_at) AS BIGINT) // 3600 * 7919 + length(queried_city) * 104729 AS BIGINT)"
_PSI = "(ln(n) - 0.5 / n - (1 / (n * n)) * (1.0 / 12 - (1 / (n * n)) * (1.0 / 120 - (1 / (n * n)) / 252)))"


def _psi_sql(n: str) -> str:
    """Digamma of a whole number: the harmonic sum while small, then the series."""
    return (f"CASE WHEN {n} <= 24 THEN coalesce((SELECT SUM(1.0 / j) FROM range(1, 24) r(j) WHERE j < {n}), 0) - 0.5772156649015329 "
            f"ELSE {_PSI.replace('n)', f'CAST({n} AS DOUBLE))').replace('/ n', f'/ CAST({n} AS DOUBLE)').replace('(n ', f'(CAST({n} AS DOUBLE) ')} END")


@query("neighbour_mutual_info", with_views(READINGS, hourly_cte(), f"""
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS a, aqi AS b, ({_STEP} % 1000003) / 1000003.0 * 1e-10 AS jitter FROM h WHERE {c} IS NOT NULL" for c in _MI_FEATURES)}),
s AS (SELECT feature, {r6('stddev_pop(a)')} AS sa, {r6('stddev_pop(b)')} AS sb, COUNT(*) AS n FROM l GROUP BY 1),
p AS (SELECT l.feature, ROW_NUMBER() OVER () AS id, CASE WHEN sa > 0 THEN a / sa ELSE 0 END + jitter AS x, CASE WHEN sb > 0 THEN b / sb ELSE 0 END + jitter AS y
      FROM l JOIN s USING (feature)),
d AS (SELECT p.feature, p.id, any_value(p.x) AS x, any_value(p.y) AS y, min(greatest(abs(q.x - p.x), abs(q.y - p.y)), 3)[3] * (1 - 1e-12) AS r
      FROM p JOIN p q ON p.feature = q.feature AND p.id <> q.id GROUP BY 1, 2),
c AS (SELECT d.feature, d.id, greatest(COUNT(*) FILTER (p.x > d.x - r AND p.x < d.x + r), 1) AS n_x,
        greatest(COUNT(*) FILTER (p.y > d.y - r AND p.y < d.y + r), 1) AS n_y
      FROM d JOIN p ON p.feature = d.feature GROUP BY 1, 2),
t AS (SELECT feature, AVG({_psi_sql('n_x')} + {_psi_sql('n_y')}) AS m FROM c GROUP BY 1)""") + f"""
SELECT s.feature, s.n, {r6(f"greatest({_psi_sql('s.n')} + {_psi_sql('3')} - m, 0.0)")} AS mutual_info FROM s JOIN t USING (feature)""")
def q_neighbour_mutual_info(spark, sf_dir):
    """Hourly features against aqi by three nearest neighbours."""
    h = W.hourly(readings(spark, sf_dir))
    step = F.floor(F.unix_seconds("measured_at") / 3600) * 7919 + F.length("queried_city") * 104729
    return neighbour_mutual_info(h, _MI_FEATURES, "aqi", jitter=(step % 1000003) / F.lit(1000003.0) * F.lit(1e-10))
