"""Models that Spark ML has: thin pipelines with the parameters of this package."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, MODEL_PARAMS, SEED
from ..session import shared_dir
from .base import Model

COLUMNS = {"featuresCol": "_features", "labelCol": "y", "predictionCol": "_prediction"}


def estimator(code: str, rows: int, seed: int):
    p = MODEL_PARAMS[code]
    if code == "rf":
        return RandomForestClassifier(numTrees=p["trees"], maxDepth=p["depth"], featureSubsetStrategy=str(int(len(FEATURES) ** 0.5)),
                                      maxBins=128, maxMemoryInMB=1024, seed=seed, **COLUMNS)
    if code == "lr":
        # Penalty 1/C on the summed loss is 1/(C n) on the mean loss Spark minimises.
        return LogisticRegression(maxIter=p["max_iter"], regParam=1.0 / (p["c"] * rows), standardization=False, **COLUMNS)
    raise ValueError(f"unknown model code: {code}")


class SparkModel(Model):
    def __init__(self, code: str, fitted: PipelineModel):
        self.code, self.fitted = code, fitted

    @classmethod
    def fit(cls, code: str, train: DataFrame, seed: int = SEED) -> SparkModel:
        spark = train.sparkSession
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(shared_dir(spark))
        rows = train.select("y", *FEATURES).persist()
        try:
            stage = estimator(code, rows.count(), seed)
            stage.setProbabilityCol("_probability").setRawPredictionCol("_raw")
            return cls(code, Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="_features"), stage]).fit(rows))
        finally:
            rows.unpersist()

    def score(self, df: DataFrame) -> DataFrame:
        out = self.fitted.transform(df)
        return out.withColumns({
            "proba": vector_to_array("_probability")[1], "pred": F.col("_prediction").cast("int"),
        }).drop("_features", "_probability", "_raw", "_prediction")

    def save(self, spark: SparkSession, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    @classmethod
    def load(cls, code: str, path: str) -> SparkModel:
        try:
            return cls(code, PipelineModel.load(path))
        except Exception as error:  # noqa: BLE001
            if "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(path) from error
            raise
