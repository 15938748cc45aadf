"""Models made of trees with exact or histogram splits: one tree, gradient boosting, second-order boosting."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, MODEL_PARAMS
from ..sources.store import load_json, load_table, save_json, save_table
from .base import Model, Scorer, majority, scored_in_python
from .exits import Exits
from .passes import LOCAL_ROWS, TREE_SCHEMA, Block, Job, LocalPasses, SparkPasses, Tree, all_cuts, fitted
from .splits import BINS, CELLS, Gini, Learner, Residual, add_cells, exact_cuts, grow


def logistic(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -700.0, 700.0)))


class TreeModel(Model):
    """Trees whose values add up: ``start + rate * sum``, as it is or through the logistic function.

    The trees travel inside the scoring function (their size is fixed by rounds and depth, or by the capped training
    set), so nothing is left broadcast when scoring ends.
    """

    def __init__(self, trees: list[Tree], start: float = 0.0, rate: float = 1.0, link: bool = False) -> None:
        self.trees, self.start, self.rate, self.link = trees, start, rate, link

    @cached_property
    def exits(self) -> tuple[Exits, np.ndarray]:
        """All trees in one, and what each node adds."""
        parts = [tree.arrays() for tree in self.trees]
        roots = np.cumsum([0, *[len(t["feature"]) for t in parts]])
        feature, cut, missing_left, value = (np.concatenate([t[c] for t in parts]) for c in ("feature", "cut", "missing_left", "value"))
        left = np.concatenate([t["left"] + root for t, root in zip(parts, roots[:-1], strict=True)])
        return Exits(feature, cut, left, roots[:-1], missing_left), self.rate * value

    def scorer(self, spark: SparkSession) -> Callable[[], Scorer]:
        (exits, value), start, link = self.exits, self.start, self.link

        def score(x: np.ndarray) -> np.ndarray:
            m = exits.total(x, value, start)
            return logistic(m) if link else m

        return lambda: score

    def score(self, df: DataFrame) -> DataFrame:
        return scored_in_python(df, {"proba": self.scorer(df.sparkSession)}).withColumn("pred", majority(F.col("proba")))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [row for i, tree in enumerate(self.trees) for row in tree.rows(i)]
        save_table(spark.createDataFrame(rows, TREE_SCHEMA), f"{path}/trees")
        save_json(spark, {"start": self.start, "rate": self.rate, "link": self.link}, f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TreeModel:
        params, of = load_json(spark, f"{path}/params"), {}
        for row in load_table(spark, f"{path}/trees").collect():       # the nodes of a model that was fitted here
            of.setdefault(row["tree"], []).append(row)
        return cls([Tree.of(of[i]) for i in sorted(of)], **params)


# ---------------------------------------------------------------- one tree

class _Classes(Learner):
    kind = Gini

    def stats(self, block: Block) -> np.ndarray:
        return Gini.stats(block.y, np.ones(len(block.y)))


class DecisionTree(TreeModel):
    """Gini tree over every boundary; a leaf answers its share of attacks."""

    code = "dt"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, depth: int | None = MODEL_PARAMS["dt"]["depth"], local_rows: int = LOCAL_ROWS) -> DecisionTree:
        """``depth`` None grows until leaves are pure."""
        return cls([fitted(train, lambda passes: grow(passes, _Classes(), exact_cuts(passes), depth, Gini.value), local_rows)])

    def cut_to(self, depth: int | None) -> DecisionTree:
        """The tree that a fit of this depth would have given: levels do not depend on those below them."""
        if depth is None:
            return self
        tree, old = Tree(), self.trees[0]
        tree.value[0] = old.value[0]
        open_ = [(0, 0)]
        while open_:
            new, was = open_.pop(0)
            if old.feature[was] >= 0 and old.depth[was] < depth:
                left = old.left[was]
                at = tree.split(new, old.feature[was], old.cut[was], old.missing_left[was], (old.value[left], old.value[left + 1]))
                open_ += [(at, left), (at + 1, left + 1)]
        return type(self)([tree])


# ---------------------------------------------------------------- gradient boosting

class _Margins(Learner):
    """Rows with the margin of all trees so far: the written part and the trees since."""

    def __init__(self, start: float, rate: float) -> None:
        super().__init__()
        self.start, self.rate, self.recent = start, rate, []

    def margin(self, block: Block) -> np.ndarray:
        m = self.start + block.m
        for tree in self.recent:
            m = m + self.rate * tree.values(block.x)
        return m

    def next_tree(self, passes: LocalPasses | SparkPasses) -> None:
        """Keep the grown tree and start another."""
        self.recent.append(self.tree)
        recent, rate = list(self.recent), self.rate
        if passes.fold(lambda block: rate * sum(tree.values(block.x) for tree in recent)):
            self.recent = []
        self.tree = Tree()


class _Residuals(_Margins):
    kind = Residual

    def stats(self, block: Block) -> np.ndarray:
        p = logistic(self.margin(block))
        return Residual.stats(block.y - p, p * (1 - p))


class _ClassCount(Job):
    def map(self, block: Block) -> dict[int, np.ndarray]:
        return {0: np.array([len(block.y), block.y.sum()])}

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left + right


def _class_counts(passes: LocalPasses | SparkPasses) -> tuple[float, float]:
    n, attacks = passes.run(_ClassCount()).get(0, (0, 0))
    if not 0 < attacks < n:
        raise ValueError("both classes are needed to fit")
    return float(n), float(attacks)


class GradientBoosting(TreeModel):
    """Regression trees on the residuals of the log-odds, split by variance; leaves take one Newton step."""

    code = "gb"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, rounds: int | None = None, depth: int | None = None, local_rows: int = LOCAL_ROWS) -> GradientBoosting:
        p = MODEL_PARAMS["gb"]
        rounds, depth, rate = rounds or p["rounds"], depth or p["depth"], p["rate"]

        def run(passes: LocalPasses | SparkPasses) -> tuple[list[Tree], float]:
            n, attacks = _class_counts(passes)
            start = float(np.log(attacks / (n - attacks)))
            learner, cuts, trees = _Residuals(start, rate), exact_cuts(passes), []
            for _ in range(rounds):
                trees.append(grow(passes, learner, cuts, depth, Residual.value))
                learner.next_tree(passes)
            return trees, start

        trees, start = fitted(train, run, local_rows)
        return cls(trees, start, rate, True)


# ---------------------------------------------------------------- second-order boosting

class _Newton(_Margins):
    def __init__(self, start: float, rate: float, curvature: float) -> None:
        super().__init__(start, rate)
        self.curvature = curvature

    def stats(self, block: Block) -> np.ndarray:
        """Gradient and hessian of the log loss."""
        p = logistic(self.margin(block))
        return np.stack([p - block.y, np.maximum(p * (1 - p), 1e-16)], axis=1)

    def weights(self, block: Block) -> np.ndarray:
        """Hessians for the quantile sketch, in units of the first margin's."""
        return self.stats(block)[:, 1] / self.curvature


class HistogramJob(Job):
    """Gradients and hessians of open nodes by feature and bin, missing values in the last one, and the best split of each."""

    def __init__(self, learner: _Newton, nodes: list[int], cuts: list[np.ndarray], penalty: float, least: float) -> None:
        self.learner, self.nodes, self.cuts, self.penalty, self.least = learner, nodes, cuts, penalty, least

    def map(self, block: Block) -> dict[int, np.ndarray]:
        at = self.learner.tree.descend(block.x)
        where = np.full(len(self.learner.tree.feature), -1)
        where[self.nodes] = np.arange(len(self.nodes))
        slot = where[at]
        rows = np.flatnonzero(slot >= 0)
        if not len(rows):
            return {}
        codes, n_features = block.codes(self.cuts, BINS)[rows], block.x.shape[1]
        place = ((slot[rows, None] * n_features + np.arange(n_features)) * CELLS + codes).reshape(-1)
        stats = np.repeat(self.learner.stats(block)[rows], n_features, axis=0)
        grid = add_cells(place, stats, len(self.nodes) * n_features * CELLS).reshape(len(self.nodes), n_features, CELLS, 2)
        return {self.nodes[i]: grid[i] for i in np.unique(slot[rows])}

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left + right

    def worth(self, part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / (part[..., 1] + self.penalty)

    def finish(self, key: int, total: np.ndarray) -> tuple:
        """Sums of the node and (gain, feature, bin, missing left, sums left) of its best split, None if none gains."""
        whole = total[0].sum(0)
        known = np.cumsum(total[:, :BINS], axis=1)[:, :BINS - 1]
        missing = total[:, BINS:BINS + 1]
        best = None
        for missing_left in (True, False):              # without missing values both are equal and the first one stays
            left = known + missing if missing_left else known
            right = whole - left
            gain = self.worth(left) + self.worth(right) - self.worth(whole)
            fits = (left[..., 1] >= self.least) & (right[..., 1] >= self.least) & (np.arange(BINS - 1) < np.array([[len(c)] for c in self.cuts]))
            gain = np.where(fits, gain, -np.inf)
            top = gain.max()
            if top > 1e-6 and (best is None or top > best[0] + 1e-9 * abs(top)):
                f, b = np.argwhere(gain >= top - 1e-9 * abs(top))[0]
                best = (float(gain[f, b]), int(f), int(b), missing_left, left[f, b].copy())
        return whole, best


class NewtonBoosting(TreeModel):
    """Second-order boosting on histograms: gains and leaf weights from gradients and hessians with an L2 penalty.

    Bins come from a hessian-weighted quantile sketch of all rows, the first margin from one Newton step, and each split
    learns on which side missing values gain more.
    """

    code = "xgb"

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, rounds: int | None = None, depth: int | None = None, local_rows: int = LOCAL_ROWS,
            penalty: float = 1.0, least: float = 1.0) -> NewtonBoosting:
        p = MODEL_PARAMS["xgb"]
        rounds, depth, rate = rounds or p["rounds"], depth or p["depth"], p["rate"]

        def run(passes: LocalPasses | SparkPasses) -> tuple[list[Tree], float]:
            n, attacks = _class_counts(passes)
            start = 4 * (attacks / n - 0.5)
            first = logistic(np.array([start]))[0]
            learner, trees = _Newton(start, rate, float(max(first * (1 - first), 1e-16))), []
            cuts = all_cuts(passes, BINS, learner.weights)
            for _ in range(rounds):
                trees.append(cls._grow(passes, learner, cuts, depth, penalty, least))
                learner.next_tree(passes)
            return trees, start

        trees, start = fitted(train, run, local_rows)
        return cls(trees, start, rate, True)

    @staticmethod
    def _grow(passes: LocalPasses | SparkPasses, learner: _Newton, cuts: list[np.ndarray], depth: int, penalty: float, least: float) -> Tree:
        tree, open_ = learner.tree, [0]
        weight = lambda part: float(-part[0] / (part[1] + penalty))
        for _ in range(depth):
            following = []
            for node, (whole, best) in sorted(passes.run(HistogramJob(learner, open_, cuts, penalty, least)).items()):
                if node == 0:
                    tree.value[0] = weight(whole)
                if best is not None:
                    _, f, b, missing_left, left = best
                    at = tree.split(node, f, float(cuts[f][b]), missing_left, (weight(left), weight(whole - left)))
                    following += [at, at + 1]
            if not following:
                break
            open_ = following
        return tree
