"""Generated flows for runs without data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import draw, unit_draw
from ..schema import FEATURES, SEED

# Mean of every feature, share of benign rows, the two labels, default row count.
MOCK_SCALE = 100.0
MOCK_BENIGN_SHARE = 0.85
MOCK_LABELS = ("BENIGN", "DDoS-Attack")
MOCK_ROWS = 5000


def mock_columns(key: Column, seed: int = SEED) -> list[Column]:
    """Exponential features and a label, drawn from a row key; the label ignores the features."""
    uniform = lambda name: unit_draw(draw(seed, F.lit(name), key))
    features = [(-MOCK_SCALE * F.log(1.0 - uniform(f))).alias(f) for f in FEATURES]
    benign = uniform("label") < MOCK_BENIGN_SHARE
    return [*features, F.when(benign, F.lit(MOCK_LABELS[0])).otherwise(F.lit(MOCK_LABELS[1])).alias("label")]


def mock_flows(spark: SparkSession, n: int = MOCK_ROWS, seed: int = SEED) -> DataFrame:
    return spark.range(n).select(*mock_columns(F.col("id"), seed))
