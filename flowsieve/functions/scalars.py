"""Scalar functions, Column in and Column out; all of them stay in generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ATTACK_FAMILIES, BENIGN_LABELS, NO_FAMILY

FLOAT32_MAX = 3.4028234663852886e38


def strip(text: Column) -> Column:
    """Remove any white space at both ends (``trim`` alone would keep tabs)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_benign(label: Column) -> Column:
    return F.lower(strip(label.cast("string"))).isin(BENIGN_LABELS)


def binarize(label: Column) -> Column:
    """0 for a benign label, 1 for everything else, unknown or missing texts included."""
    return F.when(is_benign(label), F.lit(0)).otherwise(F.lit(1))


def attack_family(file_name: Column) -> Column:
    name = F.lower(file_name)
    first, *others = [(F.contains(name, F.lit(token)), family) for token, family in ATTACK_FAMILIES]
    chain = reduce(lambda acc, pair: acc.when(*pair), others, F.when(*first))
    return chain.otherwise(F.lit(NO_FAMILY))


def sigmoid(decision: Column) -> Column:
    """Logistic of a decision value; the exponent is clamped so that it cannot overflow."""
    d = F.greatest(F.least(decision, F.lit(700.0)), F.lit(-700.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-d))


def min_proba(p1: Column, p2: Column) -> Column:
    """Smaller of two probabilities, null when either is null (``least`` would skip the null)."""
    return F.when(p1.isNotNull() & p2.isNotNull(), F.least(p1, p2))


def guarded_rate(amount: Column, duration_us: Column) -> Column:
    """Amount per second over a duration in microseconds; 0 when no time passed."""
    return F.when(duration_us > 0, amount / (duration_us / F.lit(1e6))).otherwise(F.lit(0.0))


def rate(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(float(empty)))


def percent(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """part / whole in percent, ``empty`` where the whole is zero."""
    return F.when(whole > 0, part / whole * F.lit(100.0)).otherwise(F.lit(float(empty)))


def step(threshold: Column, direction: int) -> Column:
    """Threshold after one sensitivity step: +1 is more sensitive, i.e. a lower threshold."""
    moved = threshold - F.lit(0.05 * direction)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved))


def band(threshold: Column) -> Column:
    return (F.when(threshold < 0.3, F.lit("very high"))
            .when(threshold < 0.6, F.lit("medium"))
            .otherwise(F.lit("low")))


def float32_round(value: Column) -> Column:
    """Round a double to single precision where it fits, keeping the DOUBLE type."""
    return F.when(F.abs(value) < FLOAT32_MAX, value.cast("float").cast("double")).otherwise(value)
