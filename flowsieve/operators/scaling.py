"""Standardisation and the raw-unit feature grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FEATURES


def scaler_fit(df: DataFrame) -> DataFrame:
    """One row per feature: mean and population standard deviation; 1 for a constant feature."""
    stats = []
    for f in FEATURES:
        stats.append(F.struct(
            F.lit(f).alias("feature"), F.avg(f).alias("mean"),
            F.when(F.min(f) == F.max(f), F.lit(1.0)).otherwise(F.stddev_pop(f)).alias("scale")))
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def scaler_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """The 15 (mean, scale) pairs as literals for `scaler_apply`."""
    found = {row["feature"]: (row["mean"], row["scale"]) for row in params.collect()}
    missing = [f for f in FEATURES if f not in found]
    if missing:
        raise ValueError(f"scaler has no parameters for {missing}")
    return found


def scaler_apply(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / scale per feature; all other columns pass through."""
    return df.withColumns({f: (F.col(f) - F.lit(params[f][0])) / F.lit(params[f][1]) for f in FEATURES})


def spaced(lo: Column, hi: Column, i: Column, n: int) -> Column:
    """i-th of n evenly spaced points, both ends included; the last one is ``hi`` itself."""
    if n == 1:
        return lo
    return F.when(i == n - 1, hi).otherwise(lo + i * ((hi - lo) / F.lit(float(n - 1))))


def linspace(bounds: DataFrame, lo: str, hi: str, n: int) -> DataFrame:
    """n points between two columns of ``bounds``, for each of its rows: (i, point)."""
    points = bounds.select(F.col(lo).alias("lo"), F.col(hi).alias("hi"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    return points.select("i", spaced(F.col("lo"), F.col("hi"), F.col("i"), n).alias("point"))


def feature_grid(df: DataFrame, x: str = "flow_duration", y: str = "fwd_len_max", res: int = 40) -> DataFrame:
    """res x res points over the ranges of two features, every other feature at its mean, in raw units.

    One aggregation row expands into the grid; no join is involved.
    """
    others = [f for f in FEATURES if f not in (x, y)]
    stats = df.agg(F.min(x).alias("x_lo"), F.max(x).alias("x_hi"), F.min(y).alias("y_lo"), F.max(y).alias("y_hi"),
                   *[F.avg(f).alias(f) for f in others])
    cells = stats.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(res * res - 1))))
    ix, iy = F.col("cell") % res, F.floor(F.col("cell") / res).cast("int")
    return cells.select(
        "cell", ix.alias("ix"), iy.alias("iy"),
        *[spaced(F.col("x_lo"), F.col("x_hi"), ix, res).alias(f) if f == x
          else spaced(F.col("y_lo"), F.col("y_hi"), iy, res).alias(f) if f == y
          else F.col(f) for f in FEATURES])
