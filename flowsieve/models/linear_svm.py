"""Linear support vector machine with squared hinge loss and a regularised bias.

Minimises w.w / 2 + C * sum(max(0, 1 - y (w.x))^2) by Newton steps. Rows inside the margin enter through their
16 x 16 second moments, summed per task before the shuffle, so the driver only sees 16-dimensional statistics.
The step length is picked from a few halvings, whose losses come from one further pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sigmoid
from ..schema import FEATURES, MODEL_PARAMS
from .base import ParamModel, linear

STEPS = [1.0, 0.5, 0.25, 0.125, 0.0625, 0.03125]


def _design(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    x = pdf[FEATURES].to_numpy(dtype=np.float64)
    return np.hstack([x, np.ones((len(x), 1))]), pdf["y"].to_numpy(dtype=np.float64) * 2.0 - 1.0


def _summed(train: DataFrame, partial, size: int) -> np.ndarray:
    """Sum a per-batch statistic vector over the table: added up per task, then by position."""
    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            total += partial(*_design(pdf))
        yield pd.DataFrame({"i": np.arange(size), "v": total})

    parts = train.select("y", *FEATURES).mapInPandas(per_task, "i INT, v DOUBLE")
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for row in rows:
        out[row["i"]] = row["v"]
    return out


class LinearSvm(ParamModel):
    code = "svm"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, tolerance: float = 1e-4) -> LinearSvm:
        c, limit = MODEL_PARAMS["svm"]["c"], MODEL_PARAMS["svm"]["max_iter"]
        rows = train.select("y", *FEATURES).persist()
        try:
            return cls._solve(rows, c, limit, tolerance)
        finally:
            rows.unpersist()

    @classmethod
    def _solve(cls, train: DataFrame, c: float, limit: int, tolerance: float) -> LinearSvm:
        d = len(FEATURES) + 1
        w = np.zeros(d)
        first = None
        for _ in range(limit):
            def moments(x, y, w=w):
                inside = y * (x @ w) < 1.0
                xi = x[inside]
                return np.concatenate([(xi.T @ xi).ravel(), xi.T @ y[inside]])

            stats = _summed(train, moments, d * d + d)
            a, b = stats[: d * d].reshape(d, d), stats[d * d:]
            gradient = w + 2.0 * c * (a @ w - b)
            first = first or np.linalg.norm(gradient)
            if np.linalg.norm(gradient) <= tolerance * first:
                break
            step = np.linalg.solve(np.eye(d) + 2.0 * c * a, 2.0 * c * b) - w

            def losses(x, y, w=w, step=step):
                slack = np.maximum(0.0, 1.0 - y[:, None] * (x @ (w[:, None] + step[:, None] * np.array([0.0, *STEPS]))))
                return (slack ** 2).sum(axis=0)

            loss = _summed(train, losses, len(STEPS) + 1)
            points = [w + s * step for s in (0.0, *STEPS)]
            objective = [0.5 * p @ p + c * v for p, v in zip(points, loss)]
            best = int(np.argmin(objective))
            if best == 0:
                break
            w = points[best]
        return cls({"weights": w[:-1].tolist(), "bias": float(w[-1])})

    def score(self, df: DataFrame) -> DataFrame:
        decision = linear(self.params["weights"], self.params["bias"], FEATURES)
        return df.withColumn("proba", sigmoid(decision)).withColumn("pred", (decision > 0).cast("int"))
