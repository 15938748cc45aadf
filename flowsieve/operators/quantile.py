"""Exact quantiles without sorting the table or collecting it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 4096
SMALL = 100_000


def exact_quantile(df: DataFrame, column: str, q: float, small: int = SMALL) -> float:
    """Quantile with linear interpolation between the two order statistics around rank q * (n - 1).

    Each pass counts rows in 4,096 cells of the interval that still holds both order statistics; the interval
    shrinks until few distinct values are left, and those are read with their counts.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL").persist()
    try:
        n, lo, hi = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
        if n == 0:
            raise ValueError("no values")
        rank = q * (n - 1)
        first, second = math.floor(rank), min(math.floor(rank) + 1, n - 1)
        before = 0
        while True:
            inside = values.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy("v").count()
            found = inside.limit(small + 1).count()
            if found <= small or not lo < hi:
                break
            cell = F.least(F.floor((F.col("v") - lo) / ((hi - lo) / CELLS)), F.lit(CELLS - 1))
            cells = inside.groupBy(cell.alias("cell")).agg(F.sum("count").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            new_lo = new_hi = None
            seen = before
            for row in sorted(cells.collect(), key=lambda r: r["cell"]):
                if new_lo is None and first < seen + row["n"]:
                    new_lo, new_before = row["lo"], seen
                if new_lo is not None:
                    new_hi = row["hi"]
                    if second < seen + row["n"]:
                        break
                seen += row["n"]
            lo, hi, before = new_lo, new_hi, new_before
        seen, picked = before, []
        for row in sorted(inside.collect(), key=lambda r: r["v"]):
            for target in (first, second):
                if seen <= target < seen + row["count"]:
                    picked.append((target, row["v"]))
            seen += row["count"]
        low, high = dict(picked)[first], dict(picked)[second]
        return low + (high - low) * (rank - first)
    finally:
        values.unpersist()
