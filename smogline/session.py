"""Session helpers.

The library never creates a cluster of its own: jobs receive a ``SparkSession``.
``configure`` only sets runtime SQL options that change results or plans
(time zone, adaptive execution); ``checkpoint_dir`` reads the shared folder
named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_CONF = {
    # year/month/hour/to_date depend on the session zone; readings are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime options every job relies on (idempotent, cheap)."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "smogline") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in _RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a session on one machine (``local[...]``, as in
    tests) gets a folder of its own when that is unset; a cluster without the setting is an error, because
    executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return found.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="smogline-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its rows and their order in files are fixed from here on,
    and its size is known to the optimizer."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``smogline`` importable in the Python workers (once per application).

    Python stages (``applyInPandas``/``mapInPandas``) unpickle functions and classes of
    this package on the executors; the package is zipped on the driver and handed to
    ``SparkContext.addPyFile``, which distributes it like ``--py-files``.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import smogline

    root = os.path.dirname(os.path.abspath(smogline.__file__))
    fd, path = tempfile.mkstemp(prefix="smogline-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
