"""Near-duplicate vectors by int8 tile products with rigorous bounds.

A vector of unit length u is stored as step * q + e with q of int8 components. For two of them
|u.w - step_u step_w (q_u . q_w)| <= |e_u| + |e_w| + |e_u||e_w|, and both rest lengths are known. So the int8 products of a tile
tell most pairs apart: those whose upper bound misses the threshold are no links, those whose lower bound reaches it are
links, and only the pairs in between are computed again in double precision.

Vectors meet only vectors of their own label and length. Such a group is cut into blocks of a fixed number of vectors, and
every pair of blocks is one tile, an independent task of bounded size; a label that holds a third of all rows makes more
tiles, not larger ones. Equal vectors are one entry with a count. A tile returns at most one row per vector: how many vectors
it links with there and one member of its component, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import ready
from flowsieve.llm.partenum import components
from flowsieve.llm.vptree import usable
from flowsieve.session import attach, materialize

#: Numbers in one block: 4096 vectors of 64 components.
BLOCK_VALUES = 1 << 18
#: What double rounding may add to a product of unit vectors, far above what it does.
ROUNDING = 1e-9
CHUNK = 512


class Codes:
    """Int8 codes of vectors (finite, not zero) with their steps, rest lengths and double values."""

    def __init__(self, vectors: np.ndarray) -> None:
        top = np.abs(vectors).max(axis=1)
        self.vectors = np.ldexp(vectors, -np.frexp(top)[1][:, None])         # powers of two: cosines stay, squares fit
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))
        unit = self.vectors / self.norms[:, None]
        self.step = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.step[:, None])
        rest = unit - codes * self.step[:, None]
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest)) * (1 + ROUNDING) + ROUNDING
        self.codes = codes.astype(np.int8)

    def products(self, rows: slice, other: Codes) -> np.ndarray:
        """Integer products of codes, exact: float arithmetic holds them as long as their sums stay below its mantissa."""
        kind = np.float32 if self.codes.shape[1] * 127 * 127 < 1 << 24 else np.float64
        return (self.codes[rows].astype(kind) @ other.codes.astype(kind).T).astype(np.float64)

    def cosines(self, left: np.ndarray, other: Codes, right: np.ndarray) -> np.ndarray:
        """Cosines in double precision, summed component by component."""
        total = np.zeros(len(left))
        for j in range(self.vectors.shape[1]):
            total += self.vectors[left, j] * other.vectors[right, j]
        return total / (self.norms[left] * other.norms[right])


def tile_links(left: Codes, right: Codes, threshold: float, rows: slice, same: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """Linked places (row of left, row of right) for ``rows`` of left, and how many pairs were computed again."""
    near = left.products(rows, right) * (left.step[rows, None] * right.step[None, :])
    slack = left.rest[rows, None] + right.rest[None, :] + left.rest[rows, None] * right.rest[None, :] + ROUNDING
    possible = near + slack >= threshold
    if same:
        possible &= np.arange(len(right.step))[None, :] > np.arange(rows.start, rows.stop)[:, None]
    a, b = np.nonzero(possible)
    sure = near[a, b] - slack[a, b] >= threshold
    a += rows.start
    doubt = np.flatnonzero(~sure)
    for start in range(0, len(doubt), 1 << 20):
        some = doubt[start:start + (1 << 20)]
        sure[some] = left.cosines(a[some], right, b[some]) >= threshold
    return a[sure], b[sure], len(doubt)


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of the linked nodes a and b; ``root`` names each node's smallest known relative."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def link_tile(vectors: np.ndarray, counts: np.ndarray, first: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of every vector within a tile, weighed by the partners' counts, and one member of its component there.

    ``first`` marks the vectors of the tile's first block; a tile of the ``same`` block twice compares them with each other.
    """
    order = np.argsort(~first, kind="stable")
    n = int(first.sum())
    links, root = np.zeros(len(first), np.int64), np.arange(len(first))
    if not same and n in (0, len(first)):
        return links, root
    left = Codes(vectors[order[:n]])
    right = left if same else Codes(vectors[order[n:]])
    shift = 0 if same else n
    for start in range(0, n, CHUNK):
        a, b, _ = tile_links(left, right, threshold, slice(start, min(n, start + CHUNK)), same)
        a, b = order[a], order[b + shift]
        np.add.at(links, a, counts[b])
        np.add.at(links, b, counts[a])
        merge(root, a, b)
    return links, root


def _double_matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def classes(rows: DataFrame) -> DataFrame:
    """key, label, width, v, n, least: distinct vectors of a label, with the number of rows and the smallest id."""
    return rows.groupBy("key", "label", "width", "v").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))


def tiles(entries: DataFrame, threshold: float, block_values: int = BLOCK_VALUES) -> DataFrame:
    """key, links, root: for every tile, its vectors with links there."""
    size = F.greatest(F.lit(64), F.floor(F.lit(block_values) / F.col("width")))
    large = entries.groupBy("label", "width").agg(F.count("*").alias("rows")).withColumn("blocks", F.ceil(F.col("rows") / size).cast("int")).filter("blocks > 1").drop("rows")
    placed = attach(entries, large, ["label", "width"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    spread = placed.select("key", "label", "width", "v", "n", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        links, root = link_tile(_double_matrix(group["v"].combine_chunks()), group["n"].to_numpy(), group["block"].to_numpy() == i, i == j, threshold)
        some = np.flatnonzero(links)
        keys = group["key"].combine_chunks()
        return pa.table({"key": keys.take(pa.array(some)), "links": pa.array(links[some]), "root": keys.take(pa.array(root[some]))})

    tile = spread.select("key", "label", "width", "v", "n", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return tile.groupBy("label", "width", "i", "j").applyInArrow(run, "key string, links long, root string")


def linked_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   block_values: int = BLOCK_VALUES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: links to rows of its label with a cosine of at least ``threshold``.

    Rows whose label is null or whose vector is null, empty, zero or not finite link with nothing: no links, their own
    component, kept. Vectors of different lengths never link. Rows without id link like others but give no component its
    name and are not kept; where a component has no id at all its name is null. Rows that repeat an id are vectors of their own.
    Other columns are ignored; an empty table gives an empty result.
    """
    vector = F.col(vector_col)
    able = usable(vector) & F.col(label_col).isNotNull()
    key = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), F.col("label").cast("string"), "v")), 16, "0") for seed in (1, 2)])       # 128 bits
    rows = (ready(vectors).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("v"), able.alias("able"))
            .withColumns({"key": F.when(F.col("able"), key), "width": F.size("v")}))
    entries = materialize(classes(rows.filter("able")), "entries")
    found = materialize(tiles(entries, threshold, block_values), "tiles")
    roots = components(found.filter("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = (entries.select("key", "n", "least").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
             .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least", F.coalesce("root", "key").alias("root")))
    named = materialize(named, "linked")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    result = rows.select("vec_id", "key", "able").join(named.join(least, "root").select("key", "n_links", "component_id"), "key", "left")
    component = F.when(F.col("able"), F.col("component_id")).otherwise(F.col("vec_id"))
    return result.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: coalesce(isfinite(x), false))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
      WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
c AS (SELECT r AS node, vec_id AS root FROM v UNION SELECT p.b, c.root FROM c JOIN p ON c.node = p.a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, m.root AS component_id, coalesce(vec_id = m.root, false) AS kept
FROM v LEFT JOIN n ON v.r = n.a JOIN (SELECT node, min(root) AS root FROM c GROUP BY node) m ON v.r = m.node"""
