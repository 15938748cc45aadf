"""Approximate nearest neighbours by inner product: one vantage-point tree per shard.

Inner product is turned into a metric by one more coordinate: every vector x of a shard becomes
(x, sqrt(M^2 - |x|^2)) with M the largest norm there, every query (q, 0). All lifted vectors then have length M and
Euclidean distance falls as the inner product rises, so the triangle inequality may prune. A subtree whose distances
to its vantage point lie in [lo, hi] is skipped when d < lo - factor * tau or d > hi + factor * tau, tau being the
distance of the query's current last neighbour: factor 1 restores exact search, smaller factors prune more.

Rows are spread over shards of a fixed size. A shard's rows travel once and its tree is built once, in the task that all
queries of that shard stream through in blocks; a lost executor costs a rebuild of its shards only, and memory is bounded by
the sizes of a shard and a block. Equal vectors of a shard share one tree entry, so a very common vector costs one distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import ready

SCHEMA = "query_id long, vec_id long, score double"
#: Entries kept per query beyond k: the query's own vector and a few ties at the last place; more ties take a second walk.
SPARE = 8
#: Queries that walk a second time together.
TIED_QUERIES = 64
EPS = 1e-9
#: Production setting of the pruning factor: exact.
FACTOR = 1.0


class VPTree:
    """Vantage-point tree over lifted vectors, searched by many queries at once."""

    def __init__(self, vectors: np.ndarray, leaf: int = 128, seed: int = 7) -> None:
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.top = float(norms.max(initial=0.0))
        self.vectors = vectors
        self.lift = np.sqrt(np.maximum(self.top - norms, 0.0))
        self.leaf = max(1, leaf)
        self.rng = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(("leaf", members))
        if len(members) <= self.leaf:
            return at
        point = int(members[self.rng.integers(len(members))])
        dots = self.vectors[members] @ self.vectors[point] + self.lift[members] * self.lift[point]
        dist = np.sqrt(np.maximum(2 * (self.top - dots), 0.0))
        order = np.argsort(dist, kind="stable")
        half = len(members) // 2
        near, far = order[:half], order[half:]
        if dist[order[0]] == dist[order[-1]]:      # nothing to separate
            return at
        bounds = (dist[near].min(), dist[near].max(), dist[far].min(), dist[far].max())
        left, right = self._build(members[near]), self._build(members[far])
        self.nodes[at] = ("node", point, bounds, left, right)
        return at

    def search(self, queries: np.ndarray, keep: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Positions (-1: none) and squared lifted distances of the ``keep`` nearest of each query, in no order."""
        self.queries, self.keep, self.factor = queries, keep, factor
        self.square = np.einsum("ij,ij->i", queries, queries) + self.top
        self.best = np.full((len(queries), keep), np.inf)
        self.where = np.full((len(queries), keep), -1, dtype=np.int64)
        self.visits = 0
        if len(self.vectors) and len(queries):
            self._visit(self.root, np.arange(len(queries)))
        return self.where, self.best

    def within(self, queries: np.ndarray, bound: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, position) of every vector whose squared lifted distance is at most its query's ``bound``."""
        square = np.einsum("ij,ij->i", queries, queries) + self.top
        radius, found = np.sqrt(np.maximum(bound, 0.0)), []
        open_ = [(self.root, np.arange(len(queries)))]
        while open_:
            at, active = open_.pop()
            if not len(active):
                continue
            node = self.nodes[at]
            if node[0] == "leaf":
                dist = square[active, None] - 2 * (queries[active] @ self.vectors[node[1]].T)
                q, m = np.nonzero(dist <= bound[active, None])
                found.append((active[q], node[1][m]))
                continue
            _, point, (lo_l, hi_l, lo_r, hi_r), left, right = node
            d = np.sqrt(np.maximum(square[active] - 2 * (queries[active] @ self.vectors[point]), 0.0))
            slack = factor * radius[active] + EPS
            open_ += [(left, active[(d >= lo_l - slack) & (d <= hi_l + slack)]), (right, active[(d >= lo_r - slack) & (d <= hi_r + slack)])]
        return tuple(np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _tau(self, active: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.best[active].max(axis=1), 0.0))

    def _visit(self, at: int, active: np.ndarray) -> None:
        if not len(active):
            return
        node = self.nodes[at]
        if node[0] == "leaf":
            members = node[1]
            self.visits += len(active) * len(members)
            dist = self.square[active, None] - 2 * (self.queries[active] @ self.vectors[members].T)
            both = np.concatenate([self.best[active], dist], axis=1)
            ids = np.concatenate([self.where[active], np.broadcast_to(members, dist.shape)], axis=1)
            pick = np.argpartition(both, self.keep - 1, axis=1)[:, :self.keep]
            self.best[active] = np.take_along_axis(both, pick, axis=1)
            self.where[active] = np.take_along_axis(ids, pick, axis=1)
            return
        _, point, (lo_l, hi_l, lo_r, hi_r), left, right = node
        self.visits += len(active)
        d = np.sqrt(np.maximum(self.square[active] - 2 * (self.queries[active] @ self.vectors[point]), 0.0))
        near = d <= (hi_l + lo_r) / 2
        first, second = active[near], active[~near]
        d_first, d_second = d[near], d[~near]

        def reach(who: np.ndarray, dist: np.ndarray, lo: float, hi: float) -> np.ndarray:
            slack = self.factor * self._tau(who) + EPS
            return who[(dist >= lo - slack) & (dist <= hi + slack)]

        self._visit(left, first)
        self._visit(right, second)
        self._visit(right, reach(first, d_first, lo_r, hi_r))
        self._visit(left, reach(second, d_second, lo_l, hi_l))


def dot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component in double precision."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _distinct_ids(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each id: the smallest vector of rows that repeat it."""
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], vectors[first]


class ShardSearch:
    """The rows of one shard and their tree, built once and asked by any number of query batches."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 128) -> None:
        self.ids, vectors = _distinct_ids(ids, vectors)
        self.distinct, group = np.unique(vectors, axis=0, return_inverse=True)
        group = group.reshape(-1)
        self.by_group = np.argsort(group, kind="stable")               # ids ascend within a group
        self.starts = np.searchsorted(group[self.by_group], np.arange(len(self.distinct) + 1))
        self.tree = VPTree(self.distinct, leaf)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k nearest (query_id, vec_id, score) of each query within the shard, ties to the smaller id."""
        ids, distinct, by_group, starts, tree = self.ids, self.distinct, self.by_group, self.starts, self.tree
        where, dist = tree.search(queries, k + SPARE, factor)

        def ranked(q: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """The k best rows of each query among the entries found for it."""
            sizes = np.minimum(starts[entry + 1] - starts[entry], k + 1)   # more than k + 1 equal rows cannot all be among the nearest
            q, entry = np.repeat(q, sizes), np.repeat(entry, sizes)
            nth = np.arange(len(q)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            found = ids[by_group[starts[entry] + nth]]
            own = found == query_ids[q]
            q, entry, found = q[~own], entry[~own], found[~own]
            score = dot(queries[q], distinct[entry]) if len(q) else np.zeros(0)
            order = np.lexsort((found, -score, q))
            q, found, score = q[order], found[order], score[order]
            top = np.arange(len(q)) - np.searchsorted(q, q) < k
            return q[top], found[top], score[top]

        # All that was left out lies as far as the last one kept. Where that is no farther than the k-th (the query's own vector
        # aside), more vectors may tie with it: these queries walk again and take all up to that distance.
        near = np.sort(dist, axis=1)
        allowed = near[:, k] + 1e-9 * (1.0 + np.where(np.isfinite(tree.square), tree.square, 0.0))
        tied = np.flatnonzero(np.isfinite(near[:, -1]) & (near[:, -1] <= allowed))
        clear = np.ones(len(queries), dtype=bool)
        clear[tied] = False
        q, slot = np.nonzero((where >= 0) & clear[:, None])
        parts = [ranked(q, where[q, slot])]
        for at in range(0, len(tied), TIED_QUERIES):
            some = tied[at:at + TIED_QUERIES]
            q, entry = tree.within(queries[some], allowed[some], factor)
            parts.append(ranked(some[q], entry))
        q, found, score = (np.concatenate(part) for part in zip(*parts))
        return query_ids[q], found, score


def _runs_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray, bool]]:
    """(shard, ids, vectors, whether they ask) of each run of rows of one shard and kind."""
    width, shard, asks, ids = (batch[c].to_numpy(zero_copy_only=False) for c in ("width", "shard", "q", "id"))
    new = np.flatnonzero((width[1:] != width[:-1]) | (shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])) + 1
    for start, end in zip([0, *new], [*new, len(ids)], strict=True):
        if end > start:
            yield (int(width[start]), int(shard[start])), ids[start:end], _matrix(batch["v"].slice(start, end - start), int(width[start])), bool(asks[start])


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & fits & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = 16384, block_rows: int = 8192, leaf: int = 128) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` rows of largest inner product for every row that ``is_query``.

    Ties go to the smaller id; a query never finds its own id; with fewer candidates all are returned. Rows without
    id and vectors that are null, empty, zero or not finite take no part. Rows that repeat an id count once, with the
    smallest vector. Vectors meet only vectors of their own length. An empty table gives an empty result.
    """
    ready(vectors)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("width", F.size("v")))
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    key = F.xxhash64("id")
    candidates = rows.select("id", "v", "width", F.pmod(key, F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("q"))
    queries = rows.filter("is_query").select("id", "v", "width", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("q"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's rows come first: its tree is built when the first query follows, and stays for all of them."""
        at, known, tree, last = None, [], None, None
        for batch in batches:
            for shard, ids, vectors, asks in _runs_of(batch):
                if shard != at:
                    at, known, tree, last = shard, [], None, None
                if not asks:
                    known.append((ids, vectors))
                    continue
                if tree is None and known:
                    tree, known = ShardSearch(*(np.concatenate(part) for part in zip(*known)), leaf), []
                fresh = np.append(ids[:1] != last if last is not None else [True], ids[1:] != ids[:-1])       # of equal ids the first
                last = ids[-1]
                for start in range(0, len(ids) if tree else 0, block_rows):
                    some = np.flatnonzero(fresh[start:start + block_rows]) + start
                    if len(some):
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in tree.search(ids[some], vectors[some], k, factor)], names=["query_id", "vec_id", "score"])

    dealt = candidates.unionByName(queries).repartition("width", "shard").sortWithinPartitions("width", "shard", "q", "id", "v")
    found = dealt.select("width", "shard", "q", "id", "v").mapInArrow(search, SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
