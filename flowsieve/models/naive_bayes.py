"""Gaussian naive Bayes: one aggregation to fit, one expression to score."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sigmoid
from ..schema import FEATURES, MODEL_PARAMS
from .base import ParamModel, majority


class NaiveBayes(ParamModel):
    code = "nb"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None) -> NaiveBayes:
        """Class means, population variances and priors; variances grow by 1e-9 of the largest one overall."""
        smoothing = MODEL_PARAMS["nb"]["smoothing"]
        row = train.agg(
            *[fn(F.when(F.col("y") == y, F.col(f))).alias(f"{tag}{y}_{f}")
              for f in FEATURES for y in (0, 1) for tag, fn in (("m", F.avg), ("v", F.var_pop))],
            *[F.count_if(F.col("y") == y).alias(f"n{y}") for y in (0, 1)],
            F.greatest(*[F.var_pop(f) for f in FEATURES]).alias("widest"),
        ).first()
        if not row["n0"] or not row["n1"]:
            raise ValueError("both classes are needed to fit")
        total = row["n0"] + row["n1"]
        return cls({
            "prior": [row["n0"] / total, row["n1"] / total],
            "mean": [[row[f"m{y}_{f}"] for f in FEATURES] for y in (0, 1)],
            "var": [[row[f"v{y}_{f}"] + smoothing * row["widest"] for f in FEATURES] for y in (0, 1)]})

    def score(self, df: DataFrame) -> DataFrame:
        joint = []
        for y in (0, 1):
            total = F.lit(math.log(self.params["prior"][y]) - 0.5 * sum(math.log(2 * math.pi * v) for v in self.params["var"][y]))
            for f, m, v in zip(FEATURES, self.params["mean"][y], self.params["var"][y]):
                total = total - F.pow(F.col(f) - F.lit(m), 2) / F.lit(2.0 * v)
            joint.append(total)
        scored = df.withColumn("proba", sigmoid(joint[1] - joint[0]))
        return scored.withColumn("pred", majority(F.col("proba")))
