"""k nearest neighbours, Euclidean, uniform vote, by stored trees of boxes.

Training rows are dealt by hash into shards of at most ``SHARD_ROWS`` rows. Each shard is one row of a written table: its rows in
order of their ids and the members of a tree's leaves. Distances to the leaves' bounding boxes bound what a leaf can hold: every
row measures its nearest leaf first and then only leaves that may beat its k-th neighbour so far. With one shard (the capped
training set, bounded by ``SHARD_ROWS``) the shard is broadcast once and only the features of a scored row visit Python. With
more, scored rows travel in packed batches that hold all their columns and meet the shards by a join, and the k best of each
(batch, shard) are merged per batch. The result is exact; equal distances are settled by training row id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FEATURES, MODEL_PARAMS
from ..session import materialize, ship_package
from ..sources.store import load_table, save_table
from .base import Model, Scorer, majority, scored_in_python
from .passes import _typed

SHARD_ROWS = 65_536
LEAF = 512
SPARE = 16          # neighbours beyond k that are measured exactly
STRIP = 256         # scored rows whose bounds to a leaf are looked at together
CHUNK = 64          # scored rows per distance matrix, small enough to stay in cache
ROUNDING = 4e-6     # relative error bound of the single-precision products


def train_side(train: np.ndarray) -> np.ndarray:
    """What `scored_side` is multiplied with: the product, plus the scored row's squared norm, bounds squared distances from below."""
    norms = (train ** 2).sum(axis=1)
    return np.vstack([-2.0 * train.T, -2.0 * ROUNDING * np.sqrt(norms), norms * (1.0 - ROUNDING)]).astype(np.float32)


def scored_side(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.sqrt(own)[:, None], np.ones((len(x), 1))]).astype(np.float32)


def nearest(x: np.ndarray, train: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squared distances, training positions, labels) of each row's k nearest, ordered by (distance, position).

    One single-precision matrix product gives a lower bound of every distance: norms and the rounding error are
    two more coordinates of it. The rows with the smallest bounds are measured exactly; if the k-th of them is
    nearer than every bound left out, it is final, otherwise the row is measured against the whole block.
    """
    k = min(k, len(train))
    wide = min(k + SPARE, len(train))
    right = train_side(train)
    dist, place = np.empty((len(x), k)), np.empty((len(x), k), dtype=np.int64)
    for at in range(0, len(x), CHUNK):
        part = x[at:at + CHUNK]
        own = (part ** 2).sum(axis=1)
        lower = scored_side(part, own) @ right
        cand = np.sort(np.argpartition(lower, wide - 1, axis=1)[:, :wide], axis=1)
        exact = ((part[:, None, :] - train[cand]) ** 2).sum(axis=2)
        order = np.argsort(exact, axis=1, kind="stable")[:, :k]
        rows = np.arange(len(part))[:, None]
        d, p = exact[rows, order], cand[rows, order]
        if wide < len(train):
            left_out = lower[rows, cand].max(axis=1) + own * (1.0 - ROUNDING)
            for r in np.flatnonzero(left_out <= d[:, -1]):
                full = ((part[r] - train) ** 2).sum(axis=1)
                p[r] = np.argsort(full, kind="stable")[:k]
                d[r] = full[p[r]]
        dist[at:at + CHUNK], place[at:at + CHUNK] = d, p
    return dist, place, labels[place]


def ball_leaves(x: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Positions of the rows of each leaf, ascending: halves along the widest feature down to ``leaf`` rows."""
    done, open_ = [], [np.arange(len(x))]
    while open_:
        at = open_.pop()
        spans = np.ptp(x[at], axis=0)
        if len(at) <= leaf or not spans.max() > 0:
            done += [at[i:i + 4 * leaf] for i in range(0, len(at), 4 * leaf)]
            continue
        order = at[np.argsort(x[at, int(spans.argmax())], kind="stable")]
        open_ += [np.sort(order[:len(at) // 2]), np.sort(order[len(at) // 2:])]
    return done


class Shard:
    """Training rows in order of id with their leaves; searched for many rows at once."""

    def __init__(self, x: np.ndarray, y: np.ndarray, leaves: list[np.ndarray]) -> None:
        self.x, self.y, self.leaves = x, y, leaves
        self.sides = [train_side(x[at]) for at in leaves]
        self.lowest, self.highest = (np.array([ends(x[at], axis=0) for at in leaves]) for ends in (np.min, np.max))

    @classmethod
    def of(cls, row: dict) -> Shard:
        x = np.frombuffer(row["x"], np.float64).reshape(-1, len(FEATURES))
        order, ends = np.frombuffer(row["places"], np.int64), np.frombuffer(row["ends"], np.int64)
        return cls(x, np.frombuffer(row["y"], np.int64), np.split(order, ends[:-1]))

    def apart(self, x: np.ndarray) -> np.ndarray:
        """[leaf, row] squared distance of each row to the leaf's bounding box, less what rounding may add."""
        out = np.zeros((len(self.leaves), len(x)))
        for at in range(0, len(x), STRIP):
            part = out[:, at:at + STRIP]
            for f in range(x.shape[1]):
                v = x[at:at + STRIP, f]
                gap = np.maximum(self.lowest[:, f, None] - v, v - self.highest[:, f, None])
                np.maximum(gap, 0.0, out=gap)
                gap *= gap
                part += gap
        return out * (1.0 - 1e-12)

    def search(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(squared distances, positions) of the k nearest of each row, by (distance, position); inf and -1 where there are fewer."""
        best, place = np.full((len(x), k), np.inf), np.full((len(x), k), -1, np.int64)
        if not len(x):
            return best, place
        low = self.apart(x)
        first = low.argmin(axis=0)

        def keep(rows: np.ndarray, d: np.ndarray, p: np.ndarray) -> None:
            both, where = np.concatenate([best[rows], d], axis=1), np.concatenate([place[rows], p], axis=1)
            order = np.lexsort((where, both), axis=1)[:, :k]
            best[rows], place[rows] = np.take_along_axis(both, order, 1), np.take_along_axis(where, order, 1)

        by_leaf = np.argsort(first, kind="stable")
        ends = np.searchsorted(first[by_leaf], np.arange(len(self.leaves) + 1))
        for leaf, at in enumerate(self.leaves):
            rows = by_leaf[ends[leaf]:ends[leaf + 1]]
            if len(rows):
                d, p, _ = nearest(x[rows], self.x[at], self.y[at], k)
                keep(rows, d, at[p])
        own = (x ** 2).sum(axis=1)
        left = scored_side(x, own)
        for leaf in np.argsort(low.min(axis=1)):
            rows, at = np.flatnonzero((first != leaf) & (low[leaf] <= best[:, -1])), self.leaves[leaf]
            # Only pairs whose bound does not exceed the row's k-th distance so far are measured.
            reach = np.nextafter((best[rows, -1] - own[rows] * (1.0 - ROUNDING)).astype(np.float32), np.float32(np.inf))[:, None]
            pairs = []
            for start in range(0, len(rows), STRIP):
                strip = slice(start, start + STRIP)
                hit = np.flatnonzero(left[rows[strip]] @ self.sides[leaf] <= reach[strip])
                pairs.append((start + hit // len(at), hit % len(at)))
            r, c = (np.concatenate(v) for v in zip(*pairs)) if pairs else ((), ())
            if len(r):
                d = ((x[rows[r]] - self.x[at[c]]) ** 2).sum(axis=1)
                order = np.lexsort((c, d, r))
                r, c, d = r[order], c[order], d[order]
                nth = np.arange(len(r)) - np.searchsorted(r, r)
                r, c, d, nth = (v[nth < k] for v in (r, c, d, nth))
                some, row = np.unique(r, return_inverse=True)
                found, where = np.full((len(some), k), np.inf), np.full((len(some), k), np.iinfo(np.int64).max)
                found[row, nth], where[row, nth] = d, at[c]
                keep(rows[some], found, where)
        return best, place


INDEX = "shard int, ids array<string>, x binary, y binary, places binary, ends binary"


def index_table(train: DataFrame, shards: int, leaf: int = LEAF) -> DataFrame:
    """One row per shard, as `Shard.of` reads it."""
    def build(group: pa.Table) -> pa.Table:
        order = np.argsort(group["row_id"].to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        x = np.column_stack([group[f].to_numpy() for f in FEATURES]).astype(np.float64)
        leaves = ball_leaves(x, leaf)
        parts = (x, group["y"].to_numpy().astype(np.int64), np.concatenate(leaves), np.cumsum([len(at) for at in leaves]))
        return pa.table([pa.array([group["shard"][0].as_py()], pa.int32()), pa.array([group["row_id"].to_pylist()], pa.list_(pa.string())),
                         *[pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts]], names=["shard", "ids", "x", "y", "places", "ends"])

    rows = train.select(F.col("row_id").cast("string").alias("row_id"), F.col("y").cast("long").alias("y"), *[F.col(f).cast("double").alias(f) for f in FEATURES])
    return rows.withColumn("shard", F.pmod(F.xxhash64("row_id"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(build, INDEX)


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(np.float64) for f in FEATURES])


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(raw)))


def _with_proba(batch: pa.RecordBatch, known: np.ndarray, proba: np.ndarray) -> pa.RecordBatch:
    """The batch with ``proba`` of its ``known`` rows, null for the others."""
    every = np.zeros(batch.num_rows)
    every[known] = proba
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(every, mask=~known)], names=[*batch.schema.names, "proba"])


class Neighbors(Model):
    code = "knn"

    def __init__(self, index: DataFrame, shards: int, k: int):
        self.index, self.shards, self.k = index, shards, k

    @classmethod
    def fit(cls, train: DataFrame, seed: int | None = None, k: int | None = None, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> Neighbors:
        ship_package(train.sparkSession)
        rows = train.count()
        if not rows:
            raise ValueError("no training rows")
        # Hash shards vary in size; planning for 80 % keeps every one of them below the limit in practice.
        shards = 1 if rows <= shard_rows else -(-rows * 5 // (shard_rows * 4))
        return cls(materialize(index_table(train, shards, leaf), "neighbors"), shards, k or MODEL_PARAMS["knn"]["k"])

    def score(self, df: DataFrame) -> DataFrame:
        """All columns and ``proba``, the share of attacks among the k nearest, and ``pred``. A scored row without a feature gets no probability."""
        ship_package(df.sparkSession)
        df = df.drop("proba", "pred")
        scored = self._one_shard(df) if self.shards == 1 else self._many_shards(df)
        return scored.withColumn("pred", majority(F.col("proba")))

    def _shared(self, spark: SparkSession):
        """The only shard, at most ``SHARD_ROWS`` rows, as a broadcast that is made once per application."""
        app = spark.sparkContext.applicationId
        if self.__dict__.get("_sent", (None,))[0] != app:
            row = self.index.select("x", "y", "places", "ends").first().asDict()         # ids only settle ties between shards
            self._sent = (app, spark.sparkContext.broadcast({name: bytes(part) for name, part in row.items()}))
        return self._sent[1]

    def scorer(self, spark: SparkSession) -> Callable[[], Scorer] | None:
        if self.shards > 1:
            return None
        k, shared = self.k, self._shared(spark)

        def make() -> Scorer:
            shard = Shard.of(shared.value)

            def share(x: np.ndarray) -> np.ndarray:
                known, votes = np.isfinite(x).all(axis=1), np.full(len(x), np.nan)
                _, place = shard.search(x[known], min(k, len(shard.x)))
                votes[known] = shard.y[place].mean(axis=1)
                return votes

            return share

        return make

    def _one_shard(self, df: DataFrame) -> DataFrame:
        return scored_in_python(df, {"proba": self.scorer(df.sparkSession)})

    @staticmethod
    def _batches(df: DataFrame) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([_packed(batch)], pa.binary())], names=["rows"])

        return df.mapInArrow(pack, "rows binary")

    def _many_shards(self, df: DataFrame) -> DataFrame:
        k, kind = self.k, T.StructType([*df.schema.fields, T.StructField("proba", T.DoubleType())])
        batches = materialize(self._batches(df).withColumn("batch", F.monotonically_increasing_id()), "scored-batches")

        def find(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, shard = None, None
            for packed in pairs:
                for i in range(packed.num_rows):
                    row = packed.slice(i, 1).to_pylist()[0]
                    if row["shard"] != at:
                        at, shard, ids = row["shard"], Shard.of(row), np.array(row["ids"], object)
                    x = _features(_unpacked(row["rows"]))
                    known = np.isfinite(x).all(axis=1)
                    dist, place = shard.search(x[known], min(k, len(shard.x)))
                    values = pa.RecordBatch.from_arrays([pa.array(dist.reshape(-1)), pa.array(ids[place].reshape(-1), pa.string()), pa.array(shard.y[place].reshape(-1))],
                                                        names=["dist", "id", "vote"])
                    yield pa.RecordBatch.from_arrays([pa.array([row["batch"]]), pa.array([len(dist)]), pa.array([_packed(values)], pa.binary())], names=["batch", "n", "found"])

        def merge(key: tuple, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The k best of a batch's rows over all shards, part by part."""
            best = None
            for part in parts:
                for n, raw in zip(part["n"].to_pylist(), part["found"].to_pylist(), strict=True):
                    values = _unpacked(raw)
                    mine = [values.column(c).to_numpy(zero_copy_only=False) for c in ("dist", "id", "vote")]
                    mine = [v.reshape(n, -1) if n else np.zeros((0, 1)) for v in (mine[0], mine[1].astype(str), mine[2])]
                    if best is not None:
                        mine = [np.concatenate([a, b], axis=1) for a, b in zip(best, mine, strict=True)]
                    order = np.lexsort((mine[1], mine[0]), axis=1)[:, :k]
                    best = [np.take_along_axis(v, order, 1) for v in mine]
            votes = best[2].mean(axis=1).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([votes.tobytes()], pa.binary())], names=["batch", "votes"])

        def unpack(packed: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in packed:
                for row in rows.to_pylist():
                    batch = _unpacked(row["rows"])
                    yield _with_proba(batch, np.isfinite(_features(batch)).all(axis=1), np.frombuffer(row["votes"], np.float64))

        shards = F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1)))
        pairs = batches.select("batch", "rows", shards.alias("shard")).join(self.index, "shard")
        found = pairs.select("batch", "rows", *self.index.columns).mapInArrow(find, "batch long, n long, found binary")
        votes = found.groupBy("batch").applyInArrow(_typed(merge), "batch long, votes binary")
        return batches.join(votes, "batch").select("rows", "votes").mapInArrow(unpack, kind)

    def save(self, spark: SparkSession, path: str) -> None:
        save_table(self.index.withColumn("shards", F.lit(self.shards)).withColumn("k", F.lit(self.k)), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Neighbors:
        table = load_table(spark, path)
        row = table.select("shards", "k").first()
        return cls(table.drop("shards", "k"), row["shards"], row["k"])
