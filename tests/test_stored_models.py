"""The stored forest in another session, outputs attached by position, drift of distributions."""

import math
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from smogline.operators.attach import attach_by_position, with_positions
from smogline.operators.drift import distribution_drift
from smogline.operators.forest_model import IsolationForest, IsolationForestModel
from smogline.session import scratch_path


@pytest.fixture(scope="module")
def readings(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(50, 10, (400, 2)))]
    return spark.createDataFrame(rows + [(1000, 50.0, 40.0), (1001, 500.0, 450.0), (1002, None, 40.0)], "id int, aqi double, pm25 double")


def test_loaded_model_scores_alike_in_another_session(spark, readings):
    forest = IsolationForest(features=["aqi", "pm25"], keys=["id"], trees=60, samples=64, contamination=0.02)
    path = f"{scratch_path(spark, 't-forest')}/model"
    est = f"{path}-estimator"
    forest.write().overwrite().save(est)
    assert IsolationForest.load(est).value("trees") == 60
    model = IsolationForest.load(est).fit(readings)
    for _ in range(2):
        model.write().overwrite().save(path)
    loaded = IsolationForestModel.load(path)
    want = {r["id"]: (r["iforest_score"], r["is_anom_iforest"]) for r in model.transform(readings).collect()}
    again = {r["id"]: (r["iforest_score"], r["is_anom_iforest"]) for r in loaded.transform(readings.repartition(5)).collect()}
    assert again == want and len(want) == 403
    assert want[1001][0] > want[1000][0] and want[1001][1] == 1 and want[1002] == (None, None)
    assert 0 < sum(f or 0 for _, f in want.values()) <= 0.03 * len(want)
    assert loaded.transform(readings).columns == [*readings.columns, "iforest_score", "is_anom_iforest"]
    with pytest.raises(ValueError):
        loaded.transform(readings.drop("pm25"))
    readings.filter("id < 20 OR id > 999").write.parquet(f"{path}-rows")
    code = textwrap.dedent(f"""
        from smogline.session import local_session
        from smogline.operators.forest_model import IsolationForestModel
        spark = local_session(1, 1, app="other")
        rows = IsolationForestModel.load({path!r}).transform(spark.read.parquet({path + "-rows"!r})).collect()
        for r in rows:
            print("ROW", r["id"], None if r["iforest_score"] is None else r["iforest_score"].hex(), r["is_anom_iforest"])
        """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    got = {int(i): (s, f) for _, i, s, f in (line.split() for line in out.stdout.splitlines() if line.startswith("ROW"))}
    assert len(got) == 23, out.stderr[-2000:]
    assert got == {i: (str(None if want[i][0] is None else want[i][0].hex()), str(want[i][1])) for i in got}


def _in_parts(df, path, parts, fmt, cols):
    df.repartitionByRange(parts, "id").sortWithinPartitions("id").select(*cols).write.format(fmt).option("nullValue", "NA").save(path)


def test_rows_are_attached_by_position(spark):
    root = scratch_path(spark, "t-attach")
    df = spark.range(5000).select("id", (F.col("id") * 2).alias("twice"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("score"))
    _in_parts(df, f"{root}/left", 7, "parquet", ["id", "twice"])
    _in_parts(df, f"{root}/right", 3, "csv", ["score"])
    _in_parts(df.limit(4999), f"{root}/short", 2, "csv", ["score"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")  # files in several splits
    try:
        left, right = spark.read.parquet(f"{root}/left"), spark.read.schema("score long").option("nullValue", "NA").csv(f"{root}/right")
        assert right.rdd.getNumPartitions() > 3
        rows = attach_by_position(left, right).collect()
        assert len(rows) == 5000 and all(r["twice"] == 2 * r["id"] and r["score"] == (r["id"] if r["id"] % 3 else None) for r in rows)
        placed, n = with_positions(left)
        assert n == 5000 and all(r["_pos"] == r["id"] for r in placed.collect())
        with pytest.raises(ValueError, match="5000 rows against 4999"):
            attach_by_position(left, spark.read.schema("score long").option("nullValue", "NA").csv(f"{root}/short"))
        with pytest.raises(ValueError, match="in both"):
            attach_by_position(left, left)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_drift_of_the_spread_is_seen(spark):
    """Equal means: a wider feature drifts, an unchanged one doesn't; values against their definition."""
    rng = np.random.default_rng(9)
    base = {"same": rng.normal(50, 5, 3000), "wider": rng.normal(50, 5, 3000), "ties": rng.integers(0, 4, 3000).astype(float)}
    now = {"same": rng.normal(50, 5, 2000), "wider": rng.normal(50, 12, 2000), "ties": rng.integers(0, 4, 2000).astype(float)}
    rows = [(side, *map(float, r), None) for side, x in (("a", base), ("b", now)) for r in zip(*x.values(), strict=True)]
    df = spark.createDataFrame(rows + [("c", 1.0, 1.0, 1.0, 1.0), ("a", None, None, None, 2.0)],
                               "split string, same double, wider double, ties double, lone double").repartition(6)
    got = {r["feature"]: r for r in distribution_drift(df, "split", "a", "b", ["same", "wider", "ties", "lone"]).collect()}
    for c in base:
        values = np.unique(np.concatenate((base[c], now[c])))
        p, q = (np.searchsorted(np.sort(x[c]), values, "right") / len(x[c]) for x in (base, now))
        assert got[c]["ks"] == pytest.approx(np.abs(p - q).max(), abs=1e-6)
        edges = np.round(np.quantile(base[c], np.arange(1, 10) / 10) + 1e-9, 6)
        p, q = (np.maximum(np.bincount(np.searchsorted(edges, x[c], "left"), minlength=10) / len(x[c]), 1e-4) for x in (base, now))
        assert got[c]["psi"] == pytest.approx(((p - q) * np.log(p / q)).sum(), abs=1e-5)
        assert got[c]["ks_critical"] == pytest.approx(1.358 * math.sqrt(5000 / 6e6), abs=1e-6)
    assert got["wider"]["drift"] and not got["same"]["drift"] and not got["ties"]["drift"]
    assert (got["lone"]["n_baseline"], got["lone"]["n_current"], got["lone"]["ks"], got["lone"]["drift"]) == (1, 0, None, None)
