"""The isolation forest as an estimator and a model that can be stored and loaded.

``IsolationForest.fit`` samples, scales and grows as ``iforest`` does, and takes the flag's threshold from the training scores.
``IsolationForestModel`` holds the node table (bounded: trees x (2 * samples - 1) rows), the scaler and the threshold; it is
written as parameters plus a Parquet table of nodes, so that another session, or another engine, scores rows exactly alike:

    path length = splits passed + c(training rows in the leaf), score = 2 ^ -(mean path length / c(samples per tree))

Rows with a null feature get no score and no flag.
"""

from __future__ import annotations

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogline.operators import iforest, ml


class _ForestParams(Params):
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)
    keys = Param(Params._dummy(), "keys", "columns that identify a row (for the repeatable sample)", TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    samples = Param(Params._dummy(), "samples", "rows per tree, at most", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of training rows above the threshold", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of sample and splits", TypeConverters.toInt)
    standardize = Param(Params._dummy(), "standardize", "scale the features first", TypeConverters.toBoolean)
    score = Param(Params._dummy(), "score", "score column", TypeConverters.toString)
    flag = Param(Params._dummy(), "flag", "flag column", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(trees=200, samples=256, contamination=0.02, seed=42, standardize=True, score="iforest_score",
                         flag="is_anom_iforest")

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))


class IsolationForest(Estimator, _ForestParams, MLReadable, MLWritable):
    @keyword_only
    def __init__(self, *, features=None, keys=None, trees=None, samples=None, contamination=None, seed=None, standardize=None,
                 score=None, flag=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> IsolationForestModel:
        feats = list(self.value("features"))
        rows = dataset.na.drop(subset=feats)
        scaler = ml.fit_scaler(rows, feats) if self.value("standardize") else {}
        scaled = _scaled(rows, feats, scaler).persist()
        try:
            n = scaled.count()
            samples, seed = min(self.value("samples"), n), self.value("seed")
            drawn = iforest.sample_for_trees(scaled, self.value("keys"), _names(feats), self.value("trees"), self.value("samples"), seed, n=n)
            nodes = iforest.fit_forest(drawn, _names(feats), self.value("samples"), seed).toPandas()
            model = self._copyValues(IsolationForestModel(nodes, samples, scaler))
            scores = model._scored(scaled, _names(feats))
            model.threshold = iforest.thresholds(scores, [self.value("contamination")], self.value("score"))[0]
        finally:
            scaled.unpersist()
        return model

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class IsolationForestModel(Model, _ForestParams, MLReadable, MLWritable):
    def __init__(self, nodes: pd.DataFrame | None = None, samples_per_tree: int = 0,
                 scaler: dict[str, tuple[float, float]] | None = None, threshold: float = 1.0):
        super().__init__()
        self.nodes, self.samples_per_tree, self.scaler, self.threshold = nodes, samples_per_tree, scaler or {}, threshold

    def _scored(self, scaled: DataFrame, names: list[str]) -> DataFrame:
        spark = scaled.sparkSession
        nodes = spark.createDataFrame(self.nodes, iforest.NODE_SCHEMA)
        return iforest.score(spark, scaled, nodes, names, self.samples_per_tree, self.value("score"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        feats, score = list(self.value("features")), self.value("score")
        ml.require_columns(dataset, feats)
        out = self._scored(_scaled(dataset, feats, self.scaler), _names(feats))
        complete = F.lit(True)
        for c in feats:
            complete = complete & F.col(c).isNotNull()
        out = out.withColumn(score, F.when(complete, F.col(score)))
        return out.withColumn(self.value("flag"), (F.col(score) > F.lit(self.threshold)).cast("int")).drop(*_names(feats))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


def _names(feats: list[str]) -> list[str]:
    return [f"__scaled_{c}" for c in feats]


def _scaled(df: DataFrame, feats: list[str], scaler: dict[str, tuple[float, float]]) -> DataFrame:
    if not scaler:
        return df.withColumns({n: F.col(c).cast("double") for c, n in zip(feats, _names(feats), strict=True)})
    out = ml.apply_scaler(df, scaler, digits=12, suffix="__z")
    return out.withColumnsRenamed({f"{c}__z": n for c, n in zip(feats, _names(feats), strict=True)})


class _ModelWriter(MLWriter):
    def __init__(self, model: IsolationForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, model = SparkSession.active(), self.model
        extra = {"samplesPerTree": model.samples_per_tree, "threshold": model.threshold, "scaler": model.scaler}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=extra)
        spark.createDataFrame(model.nodes, iforest.NODE_SCHEMA).coalesce(1).write.parquet(f"{path}/nodes")


class _ModelReader(MLReader):
    def __init__(self, cls: type[IsolationForestModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> IsolationForestModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.schema(iforest.NODE_SCHEMA).parquet(f"{path}/nodes").toPandas()
        scaler = {c: tuple(v) for c, v in metadata["scaler"].items()}
        model = self.cls(nodes, metadata["samplesPerTree"], scaler, metadata["threshold"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
