"""Target-distribution importance resampling: hashed word counts, array-scored weights, a distributed quickselect.

Word runs are hashed into a fixed number of buckets. One pass counts them over all documents, one over all target texts; a
bucket's gain is the logarithm of its share in the target over its share in the documents. A second pass over the
documents looks the gains up in an array: a document's weight is the mean gain of its features, its score adds
Gumbel noise from a hash of its id, so the highest scores are a draw without replacement in proportion to the weights.

The draw is a quickselect over the written scores. Keys are total (score, id, counts, row number). A round picks a few
random keys of the open range as pivots and counts, exactly and in one pass, the rows below and at each of them; the
range between two pivots that holds the k-th key goes on. Ranges shrink by about the number of pivots each round, and
once all open rows are pivots the k-th key is among them. Only the winners are then sorted, by ranges, and ranked by
their place in the range and the sizes of the ranges before it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from flowsieve.llm.common import ready, rows_of, texts_as_bytes
from flowsieve.session import materialize

#: Bytes of words as they are, A-Z as a-z, everything else as a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Longer texts are taken apart between words in pieces of about this many bytes.
PIECE = 1 << 20
KNOWN_FEATURES = 300_000
PIVOTS = 24
ORDER = ["lost", "lost_id", "doc_id", "n_features", "weight", "row"]


@dataclass(frozen=True)
class Draw:
    """Longest word run, buckets, seed of the noise, least words of a document and the share of them drawn, in percent."""

    runs: int = 1
    buckets: int = 10_000
    seed: int = 2024
    least_words: int = 20
    percent: int = 10


def pieces(text: bytes) -> Iterator[bytes]:
    """The text with blanks for all that is no word, in pieces that end between words."""
    clean, start = text.translate(WORD_BYTES), 0
    while len(clean) - start > PIECE:
        end = clean.find(b" ", start + PIECE)
        if end < 0:
            break
        yield clean[start:end]
        start = end
    yield clean[start:]


class _Buckets(dict):
    """Buckets of features, remembered up to a bound."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KNOWN_FEATURES:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def features(text: bytes, known: _Buckets, runs: int) -> Iterator[tuple[np.ndarray, int]]:
    """Buckets of a text's features and its number of words, piece by piece; runs go on across pieces."""
    tail: list[bytes] = []
    for piece in pieces(text):
        words = piece.split()
        found = list(map(known.__getitem__, words))
        both = tail + words
        for n in range(2, runs + 1):
            new = max(0, len(tail) - n + 1)       # runs that end in this piece
            found += [known[b" ".join(both[i:i + n])] for i in range(new, len(both) - n + 1)]
        tail = both[len(both) - runs + 1:] if runs > 1 else []
        yield np.array(found, np.int64), len(words)


def bucket_counts(texts: DataFrame, how: Draw) -> np.ndarray:
    """How often each bucket occurs in the whole texts of a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(how.buckets), np.zeros(how.buckets, np.int64)
        for batch in rows_of(batches):
            for text in texts_as_bytes(batch["text"]):
                for found, _ in features(text, known, how.runs):
                    total += np.bincount(found, minlength=how.buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    rows = (ready(texts).select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())           # at most `buckets` rows
    counts = np.zeros(how.buckets, np.int64)
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(...)) of the smoothed shares' quotient, for each bucket."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(((t + 1) * (s_all + n)) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of the id; no id counts as empty text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weights(docs: DataFrame, gain: np.ndarray, how: Draw) -> DataFrame:
    """doc_id, n_features, n_words and weight of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(how.buckets)
        for batch in rows_of(batches):
            counts, words, means = [], [], []
            for text in texts_as_bytes(batch["text"]):
                n = total = m = 0
                for found, w in features(text, known, how.runs):
                    n, m, total = n + len(found), m + w, total + int(gain[found].sum())
                counts.append(n)
                words.append(m)
                means.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(x, pa.int64()) for x in (counts, words, means)]],
                                             names=["doc_id", "n_features", "n_words", "weight"])

    rows = ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_features long, n_words long, weight long")


def key() -> Column:
    """Total order of the draw: highest score first, then smallest id (none last), then what tells rows apart."""
    return F.struct(*ORDER)


def _literal(values: Row, kinds: dict[str, str]) -> Column:
    return F.struct(*[F.lit(values[c]).cast(kinds[c]).alias(c) for c in ORDER])


def kth_key(rows: DataFrame, k: int, seed: int = 0, pivots: int = PIVOTS) -> tuple[Row, int]:
    """The k-th smallest key (from 1) of rows with the columns `ORDER`, unique as a whole, and the number of rounds it took."""
    kinds, low, high, rounds = dict(rows.dtypes), None, None, 0
    while True:
        rounds += 1
        open_ = rows
        if low is not None:
            open_ = open_.filter((F.col("lost") >= low["lost"]) & (key() > _literal(low, kinds)))
        if high is not None:
            open_ = open_.filter((F.col("lost") <= high["lost"]) & (key() < _literal(high, kinds)))
        some = open_.orderBy(F.xxhash64("row", F.lit(seed + rounds)), "row").limit(pivots).select(*ORDER).collect()
        order = sorted(some, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))
        tests = [c for i, p in enumerate(order) for c in (F.count_if(key() < _literal(p, kinds)).alias(f"b{i}"), F.count_if(key() == _literal(p, kinds)).alias(f"e{i}"))]
        counts = open_.agg(*tests).first()
        below = 0
        for i, pivot in enumerate(order):
            before, at = counts[f"b{i}"], counts[f"e{i}"]
            if k <= before:
                high = pivot
                break
            if k <= before + at:
                return pivot, rounds
            low, below = pivot, before + at
        k -= below


def ranked(winners: DataFrame) -> DataFrame:
    """Rows with their rank by `ORDER`: sorted by ranges, numbered within, shifted by the sizes of the ranges before."""
    spark = winners.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = materialize(winners.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER).withColumn("place", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()      # one row per range
    ahead, shifts = 0, []
    for r in sizes:
        shifts.append((r["part"], ahead))
        ahead += r["n"]
    shift = spark.createDataFrame(shifts, "part long, shift long")
    return (placed.withColumn("part", part).join(F.broadcast(shift), "part")
            .withColumn("rank", F.col("shift") + F.col("place").bitwiseAND((1 << 33) - 1) + 1).drop("place", "part", "shift"))


def resampled(docs: DataFrame, target: DataFrame, how: Draw | None = None) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of ``docs``.

    Null and empty texts have no features, weight 0, and are never drawn (unless ``least_words`` is 0). Rows without id get
    the noise of an empty id and come last among equal scores. Repeated rows are rows of their own; which of entirely equal
    ones gets the smaller rank does not show. Without target texts all gains still follow from the smoothed shares. Other
    columns are ignored; an empty table gives an empty result.
    """
    how = how or Draw()
    gain = gains(bucket_counts(docs, how), bucket_counts(target, how))
    scored = weights(docs, gain, how).withColumn("score", F.col("weight") + noise(F.col("doc_id"), how.seed))
    rows = materialize(scored.withColumns({"lost": -F.col("score"), "lost_id": F.col("doc_id").isNull(), "row": F.monotonically_increasing_id()}), "scores")
    able = rows.filter(F.col("n_words") >= how.least_words)
    k = how.percent * able.count() // 100
    names = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    last, _ = kth_key(able, k)
    drawn = (F.col("n_words") >= how.least_words) & (key() <= _literal(last, dict(rows.dtypes)))
    winners = ranked(rows.filter(drawn))
    return winners.select(*names, F.col("rank").cast("long").alias("rank")).unionByName(rows.filter(~drawn).select(*names, F.lit(None).cast("long").alias("rank")))


ORACLE = r"""
WITH k AS MATERIALIZED (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
      FROM (SELECT unnest(range(256)) AS i))),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS MATERIALIZED (SELECT r, unnest(w) AS x FROM d),
g AS MATERIALIZED (SELECT unnest(w) AS x FROM b),
u AS (SELECT x, hex(x) AS h FROM (SELECT x FROM f UNION SELECT x FROM g)),
c AS MATERIALIZED (SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda a, e: xor(a >> 8, tab[(xor(a, e) & 255) + 1])), 4294967295) % 10000 AS bucket FROM u, k),
s AS (SELECT bucket, count(*) AS n FROM f JOIN c USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN c USING (x) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM f) AS s, (SELECT count(*) FROM g) AS t),
gain AS (SELECT s.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * (z.s + 10000))::DOUBLE / ((s.n + 1) * (z.t + 10000))::DOUBLE))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), z),
m AS (SELECT r, sum(gain) AS total, count(*) AS n FROM f JOIN c USING (x) JOIN gain USING (bucket) GROUP BY r),
w AS (SELECT d.r, doc_id, len(w) AS n_features, CASE WHEN len(w) = 0 THEN 0 ELSE (total - ((total % n) + n) % n) // n END::BIGINT AS weight,
      ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN m ON d.r = m.r),
v AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM w),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS nth, count(*) OVER () AS n FROM v WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= 10 * o.n // 100 THEN nth END AS rank FROM v LEFT JOIN o USING (r)"""
