"""AdaBoost (SAMME) over depth-1 trees.

A round searches the stump of least weighted Gini impurity over every boundary of every feature (`splits`). Row weights are
never stored; they follow from the stumps so far, so nothing accumulates between rounds and a lost task is simply run
again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sigmoid
from ..schema import FEATURES, MODEL_PARAMS
from .base import ParamModel, majority
from .passes import LOCAL_ROWS, Block, LocalPasses, SparkPasses, fitted
from .splits import Best, Gini, Learner, best_splits, exact_cuts


def _side(values: np.ndarray, stump: dict) -> np.ndarray:
    return np.where(values <= stump["cut"], stump["left"], stump["right"])


class _Weighted(Learner):
    """Rows weighed by the stumps so far; ``shift`` is the log of the summed weights and keeps them near 1."""

    kind = Gini

    def __init__(self) -> None:
        super().__init__()
        self.stumps, self.shift = [], 0.0

    def stats(self, block: Block) -> np.ndarray:
        log_weight = np.full(len(block.y), -self.shift)
        for s in self.stumps:
            log_weight += s["alpha"] * (_side(block.x[:, s["feature"]], s) != block.y)
        return Gini.stats(block.y, np.exp(log_weight))


def stump_of(best: Best, total: np.ndarray) -> dict:
    """A leaf takes its heavier class, benign on a tie."""
    right = total - best.left
    label = lambda part: int(part[2] > part[1])
    stump = {"feature": best.feature, "cut": best.cut, "left": label(best.left), "right": label(right)}
    missed = best.left[2 - stump["left"]] + right[2 - stump["right"]]
    return stump | {"error": float(max(missed, 0.0) / (total[1] + total[2]))}


def fit_stumps(passes: LocalPasses | SparkPasses, rounds: int) -> list[dict]:
    cuts, learner = exact_cuts(passes), _Weighted()
    for _ in range(rounds):
        total, best = best_splits(passes, learner, [0], cuts)[0]
        if best is None:
            break
        stump = stump_of(best, total)
        if stump["error"] >= 0.5:
            if not learner.stumps:
                raise ValueError("no stump is better than chance")
            break
        perfect = stump["error"] <= 1e-15
        stump["alpha"] = 1.0 if perfect else float(np.log((1.0 - stump["error"]) / stump["error"]))
        learner.stumps.append(stump)
        if perfect:
            break
        learner.shift += float(np.log(total[1] + total[2]))
    return learner.stumps


class AdaBoost(ParamModel):
    code = "ada"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, rounds: int | None = None, local_rows: int = LOCAL_ROWS) -> AdaBoost:
        rounds = rounds or MODEL_PARAMS["ada"]["rounds"]
        return cls({"stumps": fitted(train, lambda passes: fit_stumps(passes, rounds), local_rows)})

    def score(self, df: DataFrame) -> DataFrame:
        """Probability is the logistic of twice the weighted vote, so it stays within 0.119 .. 0.881."""
        vote, total = F.lit(0.0), 0.0
        for s in self.params["stumps"]:
            sign = lambda label, a=s["alpha"]: F.lit(a if label else -a)
            vote = vote + F.when(F.col(FEATURES[s["feature"]]) <= s["cut"], sign(s["left"])).otherwise(sign(s["right"]))
            total += s["alpha"]
        scored = df.withColumn("proba", sigmoid(F.lit(2.0) * vote / F.lit(total)))
        return scored.withColumn("pred", majority(F.col("proba")))
