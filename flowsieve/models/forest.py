"""Random-cut forests as node tables: shared traversal, Extra Trees and isolation forest.

A forest is five parallel arrays over all nodes. Its size is fixed by trees and depth, never by the data, and is
checked before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import draw
from ..operators.quantile import exact_quantile
from ..schema import FEATURES, IFOREST_PARAMS, MODEL_PARAMS, SEED
from ..sources.store import load_json, load_table, save_json, save_table
from .base import Model, Scorer, majority, scored_in_python
from .exits import Exits

NODE_SCHEMA = "node INT, feature INT, cut DOUBLE, left INT, value DOUBLE, is_root BOOLEAN"
MAX_NODES = 100 * 2 ** 16       # 100 trees of depth 15
SLOTS = 100_000                 # open nodes handled by one pass over the rows


class Nodes:
    """``feature`` is -1 at a leaf; the right child follows the left one; ``value`` is what a leaf answers."""

    def __init__(self, feature, cut, left, value, roots):
        self.feature = np.asarray(feature, dtype=np.int32)
        self.cut = np.asarray(cut, dtype=np.float64)
        self.left = np.asarray(left, dtype=np.int32)
        self.value = np.asarray(value, dtype=np.float64)
        self.roots = np.asarray(roots, dtype=np.int32)
        if len(self.feature) > MAX_NODES:
            raise ValueError(f"{len(self.feature)} nodes exceed the broadcast bound of {MAX_NODES}")

    def shared(self, spark: SparkSession):
        """The nodes as a broadcast, made once per application however often they score."""
        app = spark.sparkContext.applicationId
        if self.__dict__.get("_shared", (None,))[0] != app:
            self.exits                                  # found once, not by every task
            self._shared = (app, spark.sparkContext.broadcast(self))
        return self._shared[1]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_shared"}

    def descend(self, x: np.ndarray, root: int) -> np.ndarray:
        """Leaf (or open node) of each row in one tree."""
        at = np.full(len(x), root, dtype=np.int32)
        moving = np.arange(len(x))
        while len(moving):
            f = self.feature[at[moving]]
            moving, f = moving[f >= 0], f[f >= 0]
            here = at[moving]
            at[moving] = self.left[here] + (x[moving, f] > self.cut[here])
        return at

    @cached_property
    def exits(self) -> Exits:
        return Exits(self.feature, self.cut, self.left, self.roots)

    def mean_value(self, x: np.ndarray) -> np.ndarray:
        return self.exits.total(x, self.value) / len(self.roots)

    def save(self, spark: SparkSession, path: str) -> None:
        is_root = np.zeros(len(self.feature), dtype=bool)
        is_root[self.roots] = True
        save_table(spark.createDataFrame(pd.DataFrame({
            "node": np.arange(len(self.feature), dtype=np.int32), "feature": self.feature, "cut": self.cut,
            "left": self.left, "value": self.value, "is_root": is_root}), NODE_SCHEMA), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Nodes:
        table = load_table(spark, path)
        if table.count() > MAX_NODES:
            raise ValueError("stored forest exceeds the broadcast bound")
        t = table.orderBy("node").toPandas()
        return cls(t["feature"], t["cut"], t["left"], t["value"], np.flatnonzero(t["is_root"]))


def mean_leaf(df: DataFrame, nodes: Nodes, name: str) -> DataFrame:
    """Average leaf value over all trees, by an Arrow-batched function over a broadcast forest."""
    return scored_in_python(df, {name: leaf_scorer(nodes, df.sparkSession)})


def leaf_scorer(nodes: Nodes, spark: SparkSession) -> Callable[[], Scorer]:
    shared = nodes.shared(spark)
    return lambda: shared.value.mean_value


# ---------------------------------------------------------------- Extra Trees

class ExtraTrees(Model):
    """Level-wise Extra Trees: all trees grow together, two aggregations per level.

    The first gives each open node the range of every feature, from which its candidate cuts are drawn; the
    second counts classes left of each candidate. Tasks find a row's node by walking the trees built so far, so
    there is no per-row state to keep or to lose. Only per-node statistics reach the driver, in passes of at most
    ``SLOTS`` open nodes.
    """

    code = "et"

    def __init__(self, nodes: Nodes):
        self.nodes = nodes

    @classmethod
    def fit(cls, train: DataFrame, seed: int = SEED, trees: int | None = None, depth: int | None = None) -> ExtraTrees:
        trees, depth = trees or MODEL_PARAMS["et"]["trees"], depth or MODEL_PARAMS["et"]["depth"]
        candidates = int(np.sqrt(len(FEATURES)))
        rows = train.select("y", *FEATURES).persist()
        try:
            n0, n1 = rows.agg(F.count_if(F.col("y") == 0), F.count_if(F.col("y") == 1)).first()
            grown = _Growing(trees, n0, n1)
            for level in range(depth):
                for slots in grown.passes():
                    rng = np.random.default_rng([seed, level, int(slots[0])])
                    lo, hi = grown.ranges(rows, slots)
                    feature, cut = _draw_cuts(lo, hi, candidates, rng)
                    left = grown.left_counts(rows, slots, feature, cut)
                    grown.split(slots, feature, cut, left)
                grown.next_level()
            return cls(grown.nodes())
        finally:
            rows.unpersist()

    def scorer(self, spark: SparkSession) -> Callable[[], Scorer]:
        return leaf_scorer(self.nodes, spark)

    def score(self, df: DataFrame) -> DataFrame:
        return mean_leaf(df, self.nodes, "proba").withColumn("pred", majority(F.col("proba")))

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes.save(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ExtraTrees:
        return cls(Nodes.load(spark, path))


def _draw_cuts(lo: np.ndarray, hi: np.ndarray, candidates: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Per node, up to ``candidates`` random features that vary there, each with one uniform cut; -1 if none."""
    order = rng.random(lo.shape)
    order[hi <= lo] = np.inf
    feature = np.argsort(order, axis=1)[:, :candidates]
    at = np.arange(len(lo))[:, None]
    low, high = lo[at, feature], hi[at, feature]
    cut = low + rng.random(feature.shape) * (high - low)
    cut = np.where(cut >= high, low, cut)
    return np.where(np.isfinite(order[at, feature]), feature, -1).astype(np.int32), cut


class _Growing:
    """Driver-side node arrays of a forest under construction; only statistics of open nodes are held."""

    def __init__(self, trees: int, n0: int, n1: int):
        self.feature = np.full(trees, -1, dtype=np.int32)
        self.cut = np.zeros(trees)
        self.left = np.zeros(trees, dtype=np.int32)
        self.counts = np.tile(np.array([[n0, n1]], dtype=np.int64), (trees, 1))
        self.tree = np.arange(trees, dtype=np.int32)
        self.roots = np.arange(trees, dtype=np.int32)
        self.open = np.arange(trees) if n0 and n1 else np.arange(0)
        self.fresh: list[np.ndarray] = []

    def passes(self) -> list[np.ndarray]:
        return [self.open[i:i + SLOTS] for i in range(0, len(self.open), SLOTS)]

    def nodes(self) -> Nodes:
        total = np.maximum(self.counts.sum(axis=1), 1)
        return Nodes(self.feature, self.cut, self.left, self.counts[:, 1] / total, self.roots)

    def _walk(self, rows: DataFrame, slots: np.ndarray):
        """Broadcast of (nodes, slot of each node, trees with open nodes) for one pass."""
        slot = np.full(len(self.feature), -1, dtype=np.int32)
        slot[slots] = np.arange(len(slots), dtype=np.int32)
        return rows.sparkSession.sparkContext.broadcast((self.nodes(), slot, np.unique(self.tree[slots])))

    def ranges(self, rows: DataFrame, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared, size, n = self._walk(rows, slots), len(slots), len(FEATURES)

        def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            nodes, slot_of, trees = shared.value
            lo, hi = np.full((size, n), np.inf), np.full((size, n), -np.inf)
            for pdf in batches:
                x = pdf[FEATURES].to_numpy(dtype=np.float64)
                for t in trees:
                    slot = slot_of[nodes.descend(x, nodes.roots[t])]
                    order = np.argsort(slot, kind="stable")
                    order = order[np.searchsorted(slot[order], 0):]
                    if not len(order):
                        continue
                    found, starts = np.unique(slot[order], return_index=True)
                    lo[found] = np.minimum(lo[found], np.minimum.reduceat(x[order], starts))
                    hi[found] = np.maximum(hi[found], np.maximum.reduceat(x[order], starts))
            seen = np.flatnonzero(np.isfinite(lo[:, 0]))
            yield pd.DataFrame({"slot": seen, **{f"lo{f}": lo[seen, f] for f in range(n)}, **{f"hi{f}": hi[seen, f] for f in range(n)}})

        bounds = [f"{tag}{f}" for tag in ("lo", "hi") for f in range(n)]
        parts = rows.mapInPandas(per_task, "slot INT, " + ", ".join(f"{b} DOUBLE" for b in bounds))
        merged = parts.groupBy("slot").agg(*[(F.min if b[:2] == "lo" else F.max)(b).alias(b) for b in bounds]).toPandas()
        merged = merged.set_index("slot").reindex(range(size))
        shared.unpersist()
        return merged[bounds[:n]].to_numpy(), merged[bounds[n:]].to_numpy()

    def left_counts(self, rows: DataFrame, slots: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """[slot, candidate, class] rows at or below the candidate's cut."""
        shared, size, k = self._walk(rows, slots), len(slots), feature.shape[1]
        drawn = rows.sparkSession.sparkContext.broadcast((feature, cut))

        def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            nodes, slot_of, trees = shared.value
            features, cuts = drawn.value
            counts = np.zeros(size * k * 2, dtype=np.int64)
            for pdf in batches:
                x, y = pdf[FEATURES].to_numpy(dtype=np.float64), pdf["y"].to_numpy()
                for t in trees:
                    slot = slot_of[nodes.descend(x, nodes.roots[t])]
                    inside = np.flatnonzero(slot >= 0)
                    here = slot[inside]
                    for c in range(k):
                        f = features[here, c]
                        goes_left = (f >= 0) & (x[inside, f] <= cuts[here, c])
                        cell = (here[goes_left].astype(np.int64) * k + c) * 2 + y[inside[goes_left]]
                        where, times = np.unique(cell, return_counts=True)
                        counts[where] += times
            seen = np.flatnonzero(counts)
            yield pd.DataFrame({"cell": seen, "n": counts[seen]})

        parts = rows.mapInPandas(per_task, "cell LONG, n LONG").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        shared.unpersist()
        drawn.unpersist()
        left = np.zeros(size * k * 2, dtype=np.int64)
        left[parts["cell"]] = parts["n"]
        return left.reshape(size, k, 2)

    def split(self, slots: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> None:
        """Give every open node its best candidate by Gini impurity and create the two children."""
        right = self.counts[slots][:, None, :] - left
        nl, nr = left.sum(axis=2), right.sum(axis=2)
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = (nl - (left ** 2.0).sum(axis=2) / nl) + (nr - (right ** 2.0).sum(axis=2) / nr)
        impurity = np.where((feature >= 0) & (nl > 0) & (nr > 0), impurity, np.inf)
        best = np.argmin(impurity, axis=1)
        at = np.arange(len(slots))
        ok = np.isfinite(impurity[at, best])
        parent, best, at = slots[ok], best[ok], at[ok]
        first = len(self.feature)
        self.feature[parent], self.cut[parent] = feature[at, best], cut[at, best]
        self.left[parent] = first + 2 * np.arange(len(parent), dtype=np.int32)
        children = np.stack([left[at, best], right[at, best]], axis=1).reshape(-1, 2)
        grow = len(children)
        self.feature = np.concatenate([self.feature, np.full(grow, -1, dtype=np.int32)])
        self.cut = np.concatenate([self.cut, np.zeros(grow)])
        self.left = np.concatenate([self.left, np.zeros(grow, dtype=np.int32)])
        self.counts = np.concatenate([self.counts, children])
        self.tree = np.concatenate([self.tree, np.repeat(self.tree[parent], 2)])
        # A pure child is a leaf; the others are split on the next level.
        self.fresh.append(first + np.flatnonzero((children > 0).all(axis=1)))

    def next_level(self) -> None:
        self.open = np.concatenate(self.fresh) if self.fresh else np.arange(0)
        self.fresh = []


# ---------------------------------------------------------------- isolation forest

def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=np.float64)
    harmonic = np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * harmonic - 2.0 * (n - 1.0) / np.maximum(n, 1.0)))


def isolation_tree(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """One tree over at most 256 points: a random feature that varies, a uniform cut, until points are alone."""
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[list] = [[-1, 0.0, 0, 0.0]]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, members, level = todo.pop()
        points = x[members]
        varies = np.flatnonzero(points.max(axis=0) > points.min(axis=0)) if len(members) > 1 else []
        if level >= limit or len(varies) == 0:
            nodes[node][3] = level + float(average_path(len(members)))
            continue
        f = int(rng.choice(varies))
        low, high = points[:, f].min(), points[:, f].max()
        cut = float(rng.uniform(low, high))
        cut = low if cut >= high else cut
        nodes[node][:3] = [f, cut, len(nodes)]
        nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
        below = points[:, f] <= cut
        todo += [(len(nodes) - 2, members[below], level + 1), (len(nodes) - 1, members[~below], level + 1)]
    out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "value"])
    out.insert(0, "node", np.arange(len(out)))
    out.insert(0, "tree", tree)
    return out


class IsolationForest(Model):
    """Isolation forest on benign rows: every tree gets its own 256 rows, trees are built as Spark groups."""

    code = "iforest"

    def __init__(self, nodes: Nodes, sample: int, cutoff: float):
        self.nodes, self.sample, self.cutoff = nodes, sample, cutoff

    @classmethod
    def fit(cls, benign: DataFrame, seed: int = SEED, key: list[str] = ("row_id",), trees: int | None = None,
            sample: int | None = None, contamination: float | None = None) -> IsolationForest:
        trees = trees or IFOREST_PARAMS["trees"]
        contamination = IFOREST_PARAMS["contamination"] if contamination is None else contamination
        rows = benign.count()
        if rows == 0:
            raise ValueError("no benign rows to fit on")
        size = min(sample or IFOREST_PARAMS["sample"], rows)
        picked = cls._samples(benign, trees, size, rows, list(key), seed)

        def build(group: pd.DataFrame) -> pd.DataFrame:
            ordered = group.sort_values("_draw")
            return isolation_tree(int(ordered["tree"].iloc[0]), ordered[FEATURES].to_numpy(dtype=np.float64), seed)

        built = (picked.groupBy("tree").applyInPandas(build, "tree INT, node INT, feature INT, cut DOUBLE, left INT, value DOUBLE")
                 .toPandas().sort_values(["tree", "node"]))
        picked.unpersist()
        sizes = built.groupby("tree").size().to_numpy()
        offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        shift = np.repeat(offset, sizes)
        nodes = Nodes(built["feature"], built["cut"], built["left"].to_numpy() + shift, built["value"], offset)
        fitted = cls(nodes, size, float("inf"))
        fitted.cutoff = exact_quantile(fitted.anomaly_score(benign), "anomaly_score", 1.0 - contamination)
        return fitted

    @staticmethod
    def _samples(benign: DataFrame, trees: int, size: int, rows: int, key: list[str], seed: int) -> DataFrame:
        """``size`` rows per tree without replacement: the smallest draws of each (tree, row) pair.

        A per-pair hash below a generous share thins the rows before they are ranked. Should a tree ever get too
        few, the share doubles until every tree is full, up to all rows.
        """
        share = min(1.0, (size + 8.0 * np.sqrt(size) + 16.0) / rows)
        while True:
            bound = int(share * 2 ** 32)
            hit = lambda t: F.pmod(F.xxhash64(F.lit(seed), t, *key), F.lit(2 ** 32)) < F.lit(bound)
            pairs = (benign.select(*key, *FEATURES, F.explode(F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), hit)).alias("tree"))
                     .withColumn("_draw", draw(seed, "tree", *key)))
            ranked = pairs.withColumn("_rank", F.row_number().over(Window.partitionBy("tree").orderBy(
                F.pmod(F.xxhash64(F.lit(seed), "tree", *key), F.lit(2 ** 32)), "_draw")))
            picked = ranked.where(F.col("_rank") <= size).select("tree", "_draw", *FEATURES).persist()
            full = picked.groupBy("tree").count().where(F.col("count") == size).count()
            if full == trees or share >= 1.0:
                return picked
            picked.unpersist()
            share = min(1.0, share * 2.0)

    def anomaly_score(self, df: DataFrame) -> DataFrame:
        """2 ** (-mean path / expected path): near 1 for points that are isolated early."""
        expected = float(average_path(self.sample)) or 1.0
        return (mean_leaf(df, self.nodes, "_path")
                .withColumn("anomaly_score", F.pow(F.lit(2.0), -F.col("_path") / F.lit(expected))).drop("_path"))

    def score(self, df: DataFrame) -> DataFrame:
        """``pred`` 1 marks an anomaly: a score above the training cutoff."""
        return (self.anomaly_score(df).withColumn("proba", F.col("anomaly_score"))
                .withColumn("pred", (F.col("anomaly_score") > F.lit(self.cutoff)).cast("int")).drop("anomaly_score"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.nodes.save(spark, f"{path}/nodes")
        save_json(spark, {"sample": self.sample, "cutoff": self.cutoff}, f"{path}/params")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        params = load_json(spark, f"{path}/params")
        return cls(Nodes.load(spark, f"{path}/nodes"), params["sample"], params["cutoff"])
