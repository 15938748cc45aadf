"""Alerts from scored flows; stateless, so they run the same on batch tables and on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_THRESHOLD, FEATURES

ALERT_COLUMNS = ["src_ip", "src_port", "dst_ip", "dst_port", "proto"]


def usable() -> Column:
    """Every feature is present and finite."""
    ok = F.lit(True)
    for f in FEATURES:
        ok = ok & F.coalesce(F.abs(F.col(f).cast("double")) < float("inf"), F.lit(False))
    return ok


def score_flows(flows: DataFrame, score: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected): flows with unusable features are kept apart instead of vanishing."""
    return score(flows.where(usable())), flows.where(~usable())


def alerts(scored: DataFrame, threshold: float | Column = ALERT_THRESHOLD) -> DataFrame:
    """Flows whose probability reaches the threshold, initiator first, with the threshold that applied."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scored.where(F.col("proba") >= limit).select(
        *ALERT_COLUMNS, "proba", limit.alias("threshold"), "flow_duration", "fwd_packets", "bwd_packets")
