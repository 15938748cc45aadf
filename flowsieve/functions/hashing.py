"""Seeded draws computed from a row's key.

A draw depends on the key and the seed alone, never on partitioning or task order, so a re-run task
repeats it and another engine can restate it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int | str, *keys: str | Column) -> Column:
    """128-bit draw as 32 hex digits; text order equals numeric order.

    Steps that draw from one another's results need unrelated draws: name the step in the seed (``"42:split"``).
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def unit_draw(hex_draw: Column, start: int = 1) -> Column:
    """A draw's 32 bits from hex digit ``start`` as a double in [0, 1)."""
    return F.conv(F.substring(hex_draw, start, 8), 16, 10).cast("long") / F.lit(4294967296.0)
