"""What every fitted model offers: ``score`` adds ``proba`` (DOUBLE) and ``pred`` (INT) to a scaled table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FEATURES
from ..sources.store import load_json, save_json


#: Made in a task, scores the features of many rows.
Scorer = Callable[[np.ndarray], np.ndarray]


class Model:
    code: str

    def scorer(self, spark: SparkSession) -> Callable[[], Scorer] | None:
        """How a task makes the function that answers the probability, for a model that is scored in Python and calls by `majority`."""
        return None

    def score(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def save(self, spark: SparkSession, path: str) -> None:
        raise NotImplementedError


def scored_in_python(df: DataFrame, makers: dict[str, Callable[[], Scorer]]) -> DataFrame:
    """A probability column for each of ``makers``: the features visit Python once, whatever the number of models."""
    @F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in makers]))
    def probas(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorers = {name: make() for name, make in makers.items()}
        for part in parts:
            x = part.to_numpy(dtype=np.float64)
            yield pd.DataFrame({name: score(x) for name, score in scorers.items()})

    found = df.withColumn("_probas", probas(F.struct(*FEATURES)))
    return found.withColumns({name: F.col("_probas")[name] for name in makers}).drop("_probas")


class ParamModel(Model):
    """A model whose whole state is a few numbers, scored by a Column expression."""

    def __init__(self, params: dict):
        self.params = params

    def save(self, spark: SparkSession, path: str) -> None:
        save_json(spark, self.params, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ParamModel:
        return cls(load_json(spark, path))


def majority(proba: Column) -> Column:
    """Class with the larger probability; a tie is benign."""
    return (proba > 0.5).cast("int")


def linear(weights: list[float], bias: float, features: list[str]) -> Column:
    total = F.lit(float(bias))
    for w, f in zip(weights, features):
        total = total + F.lit(float(w)) * F.col(f)
    return total
