"""Centroid clustering in exact integers by Walsh-Hadamard progressive search.

Vectors become integers and are transformed once by the Walsh-Hadamard matrix H, whose rows are ordered by their sign
changes: the first coefficients hold the coarse shape. As H'H = width * I, the squared differences of coefficients add up
to ``width`` times the squared distance, and every partial sum is a lower bound of it. A search adds them coarse to
fine: after the first coefficients the leading centroid is finished, then the others go on step by step and a centroid
is dropped as soon as its partial sum is strictly above the best complete one. Survivors finish all coefficients, so
distances and ties are exact. Sums of a cluster's coefficients are the transform of the sum of its vectors, so centroids
are found from the stored coefficients, too.

A round is one pass over the written coefficients: tasks send 64 sums and one count per cluster, the driver holds the few
centroids only. A lost executor costs its tasks, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import ready
from flowsieve.session import materialize

#: Coefficients up to this magnitude are compared in 64-bit integers, larger ones in Python's.
NARROW = 1 << 27
#: Components from this magnitude on (after scaling) count as not finite: their transform would not fit 64 bits.
HUGE = 1 << 56
LONG_MAX = (1 << 63) - 1
SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Clustering:
    """Number of centroids and rounds, the salt of the first centroids, vector width (a power of two) and integer scale."""

    k: int = 8
    rounds: int = 10
    salt: int = 3
    width: int = 64
    scale: int = 1024


@lru_cache(maxsize=4)
def by_sign_changes(width: int) -> np.ndarray:
    """Places of the Hadamard matrix's rows in order of their sign changes, coarsest first."""
    i = np.arange(width)
    ones = np.array([[bin(a & b).count("1") & 1 for b in i] for a in i])
    return np.argsort((ones[:, 1:] != ones[:, :-1]).sum(1), kind="stable")


def _butterflies(x: np.ndarray) -> np.ndarray:
    width, half = x.shape[1], 1
    while half < width:
        pairs = x.reshape(-1, width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(-1, width)
        half *= 2
    return x


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of every row, coarsest first; exact for integers of any type."""
    return _butterflies(x)[:, by_sign_changes(x.shape[1])]


def restore(coefficients: np.ndarray) -> np.ndarray:
    """The rows that `transform` gave these coefficients."""
    natural = np.empty_like(coefficients)
    natural[:, by_sign_changes(coefficients.shape[1])] = coefficients
    return _butterflies(natural) // coefficients.shape[1]


def _search_wide(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """`search` in integers of any size, for the rare vectors that need them."""
    cluster, best = [], []
    for row in x.tolist():
        lead, bound = 0, None
        for g, centre in enumerate(c.tolist()):
            total = 0
            for a, b in zip(row, centre, strict=True):
                total += (a - b) ** 2
                if bound is not None and total > bound:
                    break
            else:
                if bound is None or total < bound:
                    lead, bound = g, total
        cluster.append(lead)
        best.append(bound)
    return np.array(cluster, np.int64), best


def search(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Number of the nearest of the centroids ``c`` for every row of ``x`` (both coefficients), and width * squared distance.

    Ties go to the smaller number.
    """
    if not len(x):
        return np.zeros(0, np.int64), []
    if max(np.abs(x).max(), np.abs(c).max()) > NARROW:
        return _search_wide(x, c)
    rows, width = np.arange(len(x)), x.shape[1]
    done = min(8, width)
    part = np.stack([((x[:, :done] - centre[:done]) ** 2).sum(1) for centre in c], axis=1)
    lead = part.argmin(1)
    bound = part[rows, lead] + ((x[:, done:] - c[lead, done:]) ** 2).sum(1)
    open_ = part <= bound[:, None]
    open_[rows, lead] = False
    v, g = np.nonzero(open_)
    sums = part[v, g]
    while done < width:
        upto = min(2 * done, width)
        sums = sums + ((x[v, done:upto] - c[g, done:upto]) ** 2).sum(1)
        alive = sums <= bound[v]
        v, g, sums, done = v[alive], g[alive], sums[alive], upto
    v, g, sums = np.concatenate([rows, v]), np.concatenate([lead, g]), np.concatenate([bound, sums])
    order = np.lexsort((g, sums, v))
    first = order[np.searchsorted(v[order], rows)]
    return g[first], sums[first].tolist()


def usable(vector: Column, how: Clustering) -> Column:
    """Exactly ``width`` components, none null, not finite or so large that sums would not fit."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < HUGE / how.scale))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == how.width) & fits, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def coefficients(vectors: DataFrame, how: Clustering, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the integer vector's coefficients, of every usable vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(how.scale * _matrix(batch["v"], how.width)).astype(np.int64)
            flat = pa.array(transform(x).reshape(-1))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * how.width)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.ListArray.from_arrays(ends, flat)], names=["vec_id", "coef"])

    rows = ready(vectors).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(usable(F.col("v"), how)).mapInArrow(run, "vec_id long, coef array<long>")


def first_centroids(rows: DataFrame, how: Clustering) -> np.ndarray:
    """Integer vectors of the ``k`` smallest hashes of the salted ids; rows without id come last, equal ids by vector."""
    named = F.sha2(F.concat(F.lit(f"{how.salt}:"), F.col("vec_id").cast("string")), 256)
    some = rows.select(named.alias("h"), "coef").orderBy(F.col("h").asc_nulls_last(), "coef").limit(how.k).collect()
    return restore(np.array([r["coef"] for r in some], np.int64).reshape(-1, how.width))


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floored means of the vectors nearest to each centroid; a centroid without vectors stays."""
    c, (k, width) = transform(centroids), centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), object), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch["coef"], width)
            cluster, _ = search(x, c)
            exact = x if len(x) == 0 or np.abs(x).max() <= NARROW else x.astype(object)
            for g in np.unique(cluster):
                own = cluster == g
                sums[g] += exact[own].sum(0).astype(object)
                counts[g] += own.sum()
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(some, width), pa.int32()), pa.array(np.tile(np.arange(width), len(some)), pa.int32()),
                 pa.array([Decimal(int(s)) for s in sums[some].reshape(-1)], pa.decimal128(38, 0)), pa.array(np.repeat(counts[some], width))],
                names=["cluster", "at", "total", "n"])

    added = (rows.select("coef").mapInArrow(run, "cluster int, at int, total decimal(38,0), n long")
             .groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())      # k * width rows
    sums, counts = np.zeros((k, width), object), np.zeros(k, object)
    for r in added:
        sums[r["cluster"], r["at"]] = int(r["total"])
        counts[r["cluster"]] = r["n"]
    means = restore(sums)
    return np.array([[s // n for s in means[g]] if (n := counts[g]) else centroids[g] for g in range(k)], np.int64)


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every row; a distance that no long holds is the largest long."""
    c, width = transform(centroids), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, sums = search(_matrix(batch["coef"], width), c)
            distance = [min(s // width, LONG_MAX) for s in sums]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(run, "vec_id long, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def clustered(vectors: DataFrame, how: Clustering | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Usable are vectors of exactly ``width`` components, all finite; the others get no row, and components of 2^46 or more
    count as not finite. Rows without id take part and start no centroid while rows with ids are left. Repeated rows count as
    often as they occur. With fewer vectors than ``k`` there are as many centroids as vectors. Distances and sums that no
    long holds are the largest long. Other columns are ignored; an empty table gives an empty result.
    """
    how = how or Clustering()
    rows = materialize(coefficients(vectors, how, id_col, vector_col), "coefficients")
    centroids = first_centroids(rows, how)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    for _ in range(how.rounds):
        fresh = next_centroids(rows, centroids)
        if (fresh == centroids).all():         # further rounds would repeat this one
            break
        centroids = fresh
    found = materialize(assigned(rows, centroids), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    of = [sums.get(g, 0) for g in range(len(centroids))]
    each = F.array(*[F.lit(min(s, LONG_MAX)).cast("long") for s in of])
    names = F.array(*[F.lit(digest(c)) for c in centroids])
    return found.select("vec_id", "cluster", "distance", F.get(each, F.col("cluster")).alias("cluster_inertia"),
                        F.lit(min(sum(of), LONG_MAX)).cast("long").alias("inertia"), F.get(names, F.col("cluster")).alias("centroid_sha256"))


def oracle(how: Clustering | None = None) -> str:
    """The same by SQL, one pair of views for each round."""
    how = how or Clustering()
    distance = "list_sum(list_transform(range(1, {w} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".replace("{w}", str(how.width))
    near = (f"SELECT r, vec_id, v, g, d FROM (SELECT r, vec_id, v, g, {distance}::BIGINT AS d FROM x, c{{n}}) "
            "QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, g) = 1")
    parts = [f"""WITH x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor({how.scale} * e::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {how.width} AND len(list_filter(embedding, lambda e: coalesce(isfinite(e), false))) = {how.width}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS g, v AS c FROM (SELECT v, sha256('{how.salt}:' || vec_id) AS h FROM x ORDER BY h LIMIT {how.k}))"""]
    for n in range(how.rounds):
        parts.append(f"a{n} AS MATERIALIZED ({near.format(n=n)})")
        parts.append(f"""s{n} AS (SELECT g, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, (SELECT unnest(range(1, {how.width + 1})) AS i) GROUP BY g, i),
c{n + 1} AS MATERIALIZED (SELECT g, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (SELECT g, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{n} GROUP BY g) m USING (g))""")
    parts.append(f"a{how.rounds} AS MATERIALIZED ({near.format(n=how.rounds)})")
    return ",\n".join(parts) + f"""
SELECT vec_id, a.g::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.g))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{how.rounds} a JOIN c{how.rounds} USING (g)"""
