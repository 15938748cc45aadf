"""The three-layer cascade over score columns.

Layer 1 flags suspects, layer 2 confirms them, and the anomaly layer looks at whatever ends up benign. Layers
are columns, so any pair of models can be combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import min_proba
from ..schema import ALERT_THRESHOLD


def predict_class(proba: Column) -> Column:
    """Class by largest probability: an exact tie at one half is benign."""
    return F.when(proba > 0.5, F.lit(1)).otherwise(F.lit(0))


def cascade_predict(df: DataFrame, pred1: str = "pred1", pred2: str = "pred2", name: str = "pred") -> DataFrame:
    """Layer 2's class where layer 1 says attack, benign elsewhere."""
    return df.withColumn(name, F.when(F.col(pred1) == 1, F.col(pred2)).otherwise(F.lit(0)))


def cascade_threshold(df: DataFrame, t1: float = ALERT_THRESHOLD, t2: float = ALERT_THRESHOLD,
                      p1: str = "p1", p2: str = "p2", name: str = "pred") -> DataFrame:
    """Attack where both probabilities reach their thresholds (a tie counts as attack)."""
    return df.withColumn(name, ((F.col(p1) >= t1) & (F.col(p2) >= t2)).cast("int"))


def cascade_proba(df: DataFrame, p1: str = "p1", p2: str = "p2", name: str = "proba") -> DataFrame:
    """Smaller of the two probabilities, both taken on every row."""
    return df.withColumn(name, min_proba(F.col(p1), F.col(p2)))


def cascade_detailed(df: DataFrame, anomaly: str | None = "anomaly", pred1: str = "pred1", pred2: str = "pred2",
                     name: str = "verdict") -> DataFrame:
    """0 benign, 1 attack, 2 anomaly. An anomaly only overrides a final benign, cleared suspects included.

    Without an anomaly column the verdict is the supervised cascade.
    """
    supervised = cascade_predict(df, pred1, pred2, name)
    if anomaly is None or anomaly not in df.columns:
        return supervised
    verdict = F.when(F.col(name) == 1, F.lit(1)).when(F.col(anomaly) == 1, F.lit(2)).otherwise(F.lit(0))
    return supervised.withColumn(name, verdict)
