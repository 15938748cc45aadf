"""Models by short code: fit, save, load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import MODEL_NAMES, SEED
from .ada import AdaBoost
from .base import Model
from .forest import ExtraTrees, IsolationForest
from .linear_svm import LinearSvm
from .naive_bayes import NaiveBayes
from .neighbors import Neighbors
from .spark_ml import SparkModel
from .trees import DecisionTree, GradientBoosting, NewtonBoosting

OWN = {"ada": AdaBoost, "dt": DecisionTree, "et": ExtraTrees, "gb": GradientBoosting, "knn": Neighbors, "nb": NaiveBayes, "svm": LinearSvm, "xgb": NewtonBoosting}
CODES = list(MODEL_NAMES)
ANOMALY = "iforest"


def _known(code: str) -> None:
    if code not in MODEL_NAMES:
        raise ValueError(f"unknown model code: {code}")


def fit(code: str, train: DataFrame, seed: int = SEED) -> Model:
    """Fit on a scaled table with columns ``row_id``, ``y`` and the 15 features."""
    _known(code)
    return OWN[code].fit(train, seed) if code in OWN else SparkModel.fit(code, train, seed)


def fit_iforest(benign: DataFrame, seed: int = SEED) -> IsolationForest:
    return IsolationForest.fit(benign, seed)


def save(model: Model, spark: SparkSession, folder: str) -> str:
    path = f"{folder}/{model.code}"
    model.save(spark, path)
    return path


def load(code: str, spark: SparkSession, folder: str) -> Model:
    """Raises FileNotFoundError when the model was never saved there."""
    path = f"{folder}/{code}"
    if code == ANOMALY:
        return IsolationForest.load(spark, path)
    _known(code)
    return OWN[code].load(spark, path) if code in OWN else SparkModel.load(code, path)
