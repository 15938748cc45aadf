"""Passes over the training rows: every task adds its rows into small statistics, equal keys are merged.

Training rows are packed into blocks, one table row for each Arrow batch, so that a pass decodes a few binaries instead of
many columns. A `Job` says what a block contributes, how two contributions are merged and what is left of the sum. Up to
``LOCAL_ROWS`` rows (the capped training set) a whole fit runs inside one task; beyond that, every pass is a Spark job whose
tasks merge their blocks, and the sums of a key meet in one reducer that streams them. Both run the same code on the same
jobs, and nothing but what ``finish`` returns reaches the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FEATURES
from ..session import materialize, ship_package

#: Training sets of at most so many rows are fitted inside one task.
LOCAL_ROWS = 65_536
BLOCK = "x binary, y binary, m binary"


class Block:
    """Features, targets and margins of some rows. A missing feature is NaN."""

    def __init__(self, x: np.ndarray, y: np.ndarray, m: np.ndarray) -> None:
        self.x, self.y, self.m = x, y, m
        self._codes: tuple | None = None

    def codes(self, cuts: list[np.ndarray], missing: int) -> np.ndarray:
        """Cell of every value: how many cuts lie below it (``x <= cut`` stays left); remembered for one set of cuts."""
        if self._codes is None or self._codes[0] is not cuts:
            found = np.empty(self.x.shape, np.int64)
            for f, c in enumerate(cuts):
                found[:, f] = np.where(np.isnan(self.x[:, f]), missing, np.searchsorted(c, self.x[:, f], side="left"))
            self._codes = (cuts, found)
        return self._codes[1]


class Job:
    """One pass: a block's contributions by key, their sum, and what is kept of it."""

    def map(self, block: Block) -> dict[int, object]:
        raise NotImplementedError

    def merge(self, left, right):
        raise NotImplementedError

    def finish(self, key: int, total) -> object:
        return total


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for x, y, m in zip(*(batch[c] for c in ("x", "y", "m")), strict=True):
            yield Block(np.frombuffer(x.as_buffer(), np.float64).reshape(-1, len(FEATURES)), np.frombuffer(y.as_buffer(), np.float64), np.frombuffer(m.as_buffer(), np.float64).copy())


def pack(train: DataFrame) -> DataFrame:
    """Rows with ``y`` and the features as a table of blocks with margin 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([batch[f].to_numpy(zero_copy_only=False).astype(np.float64) for f in FEATURES])
                y = batch["y"].to_numpy(zero_copy_only=False).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y, np.zeros(len(y)))], names=["x", "y", "m"])

    return train.select("y", *[F.col(f).cast("double").alias(f) for f in FEATURES]).mapInArrow(run, BLOCK)


class LocalPasses:
    """All blocks at hand, inside one task."""

    def __init__(self, blocks: list[Block]) -> None:
        self.blocks = blocks

    def run(self, job: Job) -> dict[int, object]:
        total: dict[int, object] = {}
        for block in self.blocks:
            for key, part in job.map(block).items():
                total[key] = job.merge(total[key], part) if key in total else part
        return {key: job.finish(key, part) for key, part in total.items()}

    def fold(self, add: Callable[[Block], np.ndarray]) -> bool:
        """Add to the margins of all rows; True if that was done now."""
        for block in self.blocks:
            block.m += add(block)
        return True


class SparkPasses:
    """A table of blocks; every pass is a job, margins are written into a new table every few trees."""

    FOLD = 10

    def __init__(self, blocks: DataFrame) -> None:
        self.blocks, self.waiting = blocks.persist(), 0

    def run(self, job: Job) -> dict[int, object]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, object] = {}
            for block in _blocks(batches):
                for key, part in job.map(block).items():
                    total[key] = job.merge(total[key], part) if key in total else part
            for key, part in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([pickle.dumps(part)], pa.binary())], names=["key", "part"])

        def reduce(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for raw in batch["part"].to_pylist():
                    part = pickle.loads(raw)
                    total = part if total is None else job.merge(total, part)
            done = pickle.dumps(job.finish(key[0].as_py(), total))
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([done], pa.binary())], names=["key", "part"])

        schema = "key int, part binary"
        rows = self.blocks.mapInArrow(add, schema).groupBy("key").applyInArrow(_typed(reduce), schema).collect()
        return {r["key"]: pickle.loads(r["part"]) for r in rows}

    def fold(self, add: Callable[[Block], np.ndarray]) -> bool:
        self.waiting += 1
        if self.waiting < self.FOLD:
            return False

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (block.x, block.y, block.m + add(block))], names=["x", "y", "m"])

        old, self.waiting = self.blocks, 0
        self.blocks = materialize(old.mapInArrow(run, BLOCK), "margins").persist()
        old.unpersist()
        return True

    def close(self) -> None:
        self.blocks.unpersist()


def _typed(reduce: Callable) -> Callable:
    """The grouped function with the annotations by which Spark tells its streaming form."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return reduce(key, batches)
    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def fitted(train: DataFrame, fit: Callable[[LocalPasses | SparkPasses], object], local_rows: int = LOCAL_ROWS) -> object:
    """What ``fit`` makes of the training rows: in one task up to ``local_rows`` of them, by one job a pass beyond."""
    ship_package(train.sparkSession)
    if train.limit(local_rows + 1).count() > local_rows:
        passes = SparkPasses(materialize(pack(train), "blocks"))
        try:
            return fit(passes)
        finally:
            passes.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = sorted(_blocks(batches), key=lambda b: (len(b.y), b.x.tobytes()))         # a fit repeats whatever the tasks' order
        try:
            done = (True, fit(LocalPasses(blocks)))
        except ValueError as error:
            done = (False, str(error))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(done)], pa.binary())], names=["model"])

    ok, model = pickle.loads(pack(train).repartition(1).mapInArrow(run, "model binary").first()["model"])
    if not ok:
        raise ValueError(model)
    return model


# ---------------------------------------------------------------- cuts

class Sketch:
    """Mergeable weighted quantile summary of one feature: sorted distinct values with their weights.

    Up to ``size`` values it is exact. Beyond that neighbours are merged into the larger of them so that none but single
    values hold more than a ``size``-th of the weight; a summary merged pairwise from 2^l parts is off by l / size at most.
    """

    def __init__(self, values: np.ndarray, weights: np.ndarray, size: int) -> None:
        self.size = size
        distinct, at = np.unique(values, return_inverse=True)
        total = np.bincount(at, weights, len(distinct))
        if len(distinct) > size:
            place = np.floor(np.cumsum(total) * (size - 1) / total.sum()).astype(np.int64)
            last = np.append(place[1:] != place[:-1], True)
            group = np.cumsum(np.append(False, last[:-1]))
            distinct, total = distinct[last], np.bincount(group, total)
        self.values, self.weights = distinct, total

    def __add__(self, other: Sketch) -> Sketch:
        return Sketch(np.concatenate([self.values, other.values]), np.concatenate([self.weights, other.weights]), self.size)

    def cuts(self, bins: int) -> np.ndarray:
        """At most ``bins`` - 1 cuts, each just below a value, that leave about equal weights between them."""
        if len(self.values) < 2:
            return np.zeros(0)
        cum, total = np.cumsum(self.weights), self.weights.sum()
        if len(self.values) <= bins:
            ends = np.arange(len(self.values) - 1)
        else:
            ends = np.unique(np.searchsorted(cum * bins, np.arange(1, bins) * total, side="left"))
            ends = ends[ends < len(self.values) - 1]
        return np.nextafter(self.values[ends + 1], -np.inf)


class CutJob(Job):
    """Cuts of every feature from the weighted summaries of all rows; summaries of equally many parts are merged first."""

    def __init__(self, bins: int, weights: Callable[[Block], np.ndarray] | None = None, size: int = 1 << 15) -> None:
        self.bins, self.weights, self.size = bins, weights, size

    def map(self, block: Block) -> dict[int, object]:
        w = np.ones(len(block.y)) if self.weights is None else self.weights(block)
        some = [np.isfinite(block.x[:, f]) for f in range(block.x.shape[1])]
        return {f: {0: Sketch(block.x[s, f], w[s], self.size)} for f, s in enumerate(some)}

    def merge(self, left: dict, right: dict) -> dict:
        out = dict(left)
        for level, sketch in right.items():
            while level in out:
                sketch = out.pop(level) + sketch
                level += 1
            out[level] = sketch
        return out

    def finish(self, key: int, total: dict) -> np.ndarray:
        parts = [total[level] for level in sorted(total)]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole + part
        return whole.cuts(self.bins)


def all_cuts(passes: LocalPasses | SparkPasses, bins: int, weights: Callable[[Block], np.ndarray] | None = None) -> list[np.ndarray]:
    found = passes.run(CutJob(bins, weights))
    if not found:
        raise ValueError("no training rows")
    return [found[f] for f in range(len(FEATURES))]


# ---------------------------------------------------------------- trees

class Tree:
    """A binary tree as parallel lists: ``x <= cut`` goes to ``left``, others to the node after it, missing values as ``missing_left`` says."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.missing_left, self.value, self.depth = [-1], [0.0], [-1], [False], [0.0], [0]

    def split(self, node: int, feature: int, cut: float, missing_left: bool, values: tuple[float, float]) -> int:
        """Make ``node`` inner; returns its left child, the right one follows."""
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.missing_left[node] = feature, cut, at, missing_left
        for value in values:
            self.feature.append(-1)
            self.cut.append(0.0)
            self.left.append(-1)
            self.missing_left.append(False)
            self.value.append(value)
            self.depth.append(self.depth[node] + 1)
        return at

    def arrays(self) -> dict[str, np.ndarray]:
        return {"feature": np.array(self.feature, np.int32), "cut": np.array(self.cut), "left": np.array(self.left, np.int32),
                "missing_left": np.array(self.missing_left), "value": np.array(self.value), "depth": np.array(self.depth, np.int32)}

    def descend(self, x: np.ndarray, deepest: int | None = None) -> np.ndarray:
        """Node each row ends in, going down at most ``deepest`` levels."""
        t = self.arrays()
        at = np.zeros(len(x), np.int32)
        moving = np.arange(len(x))
        level = 0
        while len(moving) and (deepest is None or level < deepest):
            moving = moving[t["feature"][at[moving]] >= 0]
            here = at[moving]
            v = x[moving, t["feature"][here]]
            right = np.where(np.isnan(v), ~t["missing_left"][here], v > t["cut"][here])
            at[moving] = t["left"][here] + right
            level += 1
        return at

    def values(self, x: np.ndarray, deepest: int | None = None) -> np.ndarray:
        return np.array(self.value)[self.descend(x, deepest)]

    def rows(self, number: int) -> list[tuple]:
        return [(number, i, int(f), float(c), int(l), bool(m), float(v), int(d)) for i, (f, c, l, m, v, d) in
                enumerate(zip(self.feature, self.cut, self.left, self.missing_left, self.value, self.depth, strict=True))]

    @classmethod
    def of(cls, rows: list) -> Tree:
        tree = cls()
        rows = sorted(rows, key=lambda r: r["node"])
        tree.feature, tree.cut, tree.left, tree.missing_left, tree.value, tree.depth = ([r[c] for r in rows] for c in ("feature", "cut", "left", "missing_left", "value", "depth"))
        return tree


TREE_SCHEMA = "tree int, node int, feature int, cut double, left int, missing_left boolean, value double, depth int"
