"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are bounded statistics of the whole text. Labelled rows are joined with their documents, features are computed
where the rows lie, and at most ``max_rows`` of them (the smallest by a hash of the id) reach the driver, where second-
order boosting works on quantile-binned columns. The fitted trees are flattened into arrays of one fixed size (trees x
nodes), and every task walks them for whole batches at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import crc_mod, ready, rows_of, texts_as_bytes

FEATURES = ("log_bytes", "log_words", "mean_word", "upper_share", "digit_share", "punct_share", "symbol_share", "white_share",
            "wide_share", "distinct_share", "log_lines", "mean_line", "dup_line_share", "end_mark_share", "capital_share",
            "pipe_share", "bang_share", "top_word_share", "dup_pair_share", "stop_share")
#: Frequent short words of the languages served.
STOPS = frozenset((b"the of and to in a is that for it as was with be by on not he his this from at which or an are "
                   b"de la le les et des en un une du que el los las y se del al der die und das ist zu den von mit").split())
_CLASS = np.zeros((256, 6))
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = [_ch.isascii() and _ch.isupper(), _ch.isascii() and _ch.isdigit(), _ch in ".,;:?!'\"()-",
                  _ch in "#*$%&|<>{}[]\\^~=+_@`/", _ch in " \t\n\x0b\x0c\r", _c >= 128]


def statistics(text: bytes) -> list[float]:
    """The features of one text, in the order of FEATURES; an empty text gives zeros."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts @ _CLASS / n
    words = text.lower().split()
    m = len(words)
    lines = [x for x in (line.strip() for line in text.split(b"\n")) if x]
    k = max(1, len(lines))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    raw = text.split()
    d = max(1, m)
    return [np.log1p(n), np.log1p(m), sum(map(len, words)) / d, *shares, len(seen) / d, np.log1p(len(lines)), n / k / 100.0,
            1 - len(set(lines)) / k if lines else 0.0, sum(x[-1:] in b".!?" for x in lines) / k,
            sum(w[:1].isupper() for w in raw) / d, counts[124] / n, counts[33] / n, max(seen.values(), default=0) / d,
            1 - pairs / max(1, m - 1) if m > 1 else 0.0, sum(seen.get(s, 0) for s in STOPS) / d]


def feature_matrix(column: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in texts_as_bytes(column)], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class Trees:
    """Complete binary trees in arrays: node i has children 2i + 1 and 2i + 2; a node with feature -1 repeats its value below."""

    base: float
    feature: np.ndarray      # trees x nodes, -1: leaf
    cut: np.ndarray          # go left when x <= cut
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > cut[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64,
              l2: float = 1.0, min_rows: int = 10, min_gain: float = 1e-6) -> Trees:
    """Boost log loss: per level, gradients and counts are summed per node and bin, the best cut of each node is kept.

    Without rows, or with labels all equal, the trees are empty and every score is the smoothed share of label 1.
    """
    nodes = 2 ** (depth + 1) - 1
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    feature = np.full((trees, nodes), -1, dtype=np.int32)
    cut, value = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    out = Trees(base, feature, cut, value, depth)
    if not len(y) or y.min() == y.max():
        out.feature, out.cut, out.value = feature[:0], cut[:0], value[:0]
        return out
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)   # bin b: x <= edges[b]
    margin = np.full(len(y), base)
    n_features = x.shape[1]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth + 1):
            first, width = 2 ** level - 1, 2 ** level
            live = at >= first
            local = at[live] - first
            g = np.bincount(local, grad[live], width)
            h = np.bincount(local, hess[live], width)
            value[t, first:first + width] = -rate * g / (h + l2)
            if level == depth:
                break
            best = np.full(width, min_gain)
            for f in range(n_features):
                key = local * bins + binned[live, f]
                hg = np.bincount(key, grad[live], width * bins).reshape(width, bins).cumsum(axis=1)
                hh = np.bincount(key, hess[live], width * bins).reshape(width, bins).cumsum(axis=1)
                hn = np.bincount(key, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
                usable = len(edges[f])
                if not usable:
                    continue
                lg, lh, ln = hg[:, :usable], hh[:, :usable], hn[:, :usable]
                gain = lg ** 2 / (lh + l2) + (g[:, None] - lg) ** 2 / (h[:, None] - lh + l2) - (g ** 2 / (h + l2))[:, None]
                gain[(ln < min_rows) | (hn[:, -1:] - ln < min_rows)] = 0
                pick = gain.argmax(axis=1)
                better = gain[np.arange(width), pick] > best
                best = np.where(better, gain[np.arange(width), pick], best)
                feature[t, first:first + width][better] = f
                cut[t, first:first + width][better] = edges[f][pick[better]]
            f = feature[t, at]
            inner = live & (f >= 0)
            right = x[np.arange(len(y)), np.maximum(f, 0)] > cut[t, at]
            at = np.where(inner, 2 * at + 1 + right, at)
        margin += value[t, at]
    return out


@dataclass(frozen=True)
class Fit:
    """``max_rows``: the documented bound on labelled rows that reach the driver."""

    max_rows: int = 50_000
    trees: int = 120
    depth: int = 4


def training_features(docs: DataFrame, labels: DataFrame, fit: Fit, label: str = "quality",
                      held_out_mod: int | None = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled rows outside the held-out part.

    Labels other than 0 and 1 and null ids teach nothing; an id labelled more than once has its larger label.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)))
    if held_out_mod:
        known = known.filter(crc_mod(F.col("doc_id"), held_out_mod) != 1)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    # the smallest ids by hash: at most max_rows, so the side that is broadcast is bounded
    known = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.max_rows))
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(known, "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            x = feature_matrix(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["y"], pa.array(x.tolist(), pa.list_(pa.float64()))],
                                             names=["doc_id", "y", "x"])

    rows = joined.mapInArrow(measure, "doc_id long, y int, x array<double>")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(fit.max_rows).toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return x, rows["y"].to_numpy().astype(float)


def score_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, score, predicted for every row; null text counts as empty, repeated rows are scored alike."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            p = trees.probability(feature_matrix(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    rows = ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, fit: Fit | None = None, held_out_mod: int = 3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; labels are learnt only from rows that are not held out.

    An empty table of documents gives an empty result; without labels every score is 0.5. Columns besides doc_id and
    text are never read.
    """
    fit = fit or Fit()
    ready(docs)
    trees = fit_trees(*training_features(docs, labels, fit, held_out_mod=held_out_mod), trees=fit.trees, depth=fit.depth)
    scored = score_documents(docs, trees)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), held_out_mod) == 1).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, fit: Fit | None = None) -> DataFrame:
    """The documents predicted to be of quality 1, all columns unchanged.

    Null and empty texts have the statistics of an empty text and are judged by them; repeated rows stay or go together. Ids
    only choose the labelled rows to fit on. An empty table gives an empty result.
    """
    fit = fit or Fit()
    ready(docs)
    trees = fit_trees(*training_features(docs, labels, fit), trees=fit.trees, depth=fit.depth)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            yield batch.filter(pa.array(trees.probability(feature_matrix(batch["text"])) >= 0.5))

    return docs.mapInArrow(pick, docs.schema)
