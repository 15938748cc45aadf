"""Importance resampling against a plain version, and the quickselect alone."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.llm import resample
from flowsieve.llm.resample import Draw

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, target, how):
    def found(text):
        words = WORDS.findall((text or "").translate(LOWER))
        return [zlib.crc32(" ".join(words[i:i + n]).encode()) % how.buckets for n in range(1, how.runs + 1) for i in range(len(words) - n + 1)], len(words)
    own = [found(t) for _, t in rows]
    s, t = np.zeros(how.buckets, int), np.zeros(how.buckets, int)
    for f, _ in own:
        np.add.at(s, f, 1)
    for text in target:
        np.add.at(t, found(text)[0], 1)
    gain = [math.floor(1000 * math.log((int(b) + 1) * (int(s.sum()) + how.buckets) / ((int(a) + 1) * (int(t.sum()) + how.buckets)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (f, words) in zip(rows, own):
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    drawn = able[:how.percent * len(able) // 100]
    ranks = {id(r): n + 1 for n, r in enumerate(drawn)}
    return sorted((tuple([*r[:4], ranks.get(id(r))]) for r in out), key=str)


@pytest.mark.parametrize("how", [Draw(), Draw(percent=60, least_words=4, runs=3, buckets=97), Draw(percent=100, least_words=0)])
def test_draw_is_the_plain_one(spark, odd, odd_rows, how):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(200)] + ["Été", "漢字", "x-y", "UPPER"]
    more = [(100 + i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(150)] + [(5, "tie " * 30)] * 4
    target = [" ".join(vocabulary[:40]), None, "", "w1 w2 w3 " * 5]
    docs = odd.select("doc_id", "text", "score", "key").unionByName(spark.createDataFrame([(i, t, "c", "c") for i, t in more], "doc_id long, text string, score string, key string")).repartition(4)
    got = resample.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), how).collect()
    want = plain([(r[0], r[1]) for r in odd_rows] + more, target, how)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "text string")
    assert resample.resampled(empty, none).collect() == []
    short = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (row,) = resample.resampled(short, none).collect()
    assert row["n_features"] == 3 and row["rank"] is None


def test_long_texts_are_read_whole_in_pieces(monkeypatch):
    monkeypatch.setattr(resample, "PIECE", 50)
    text = ("Alpha beta-gamma, " * 40 + "x" * 300 + " end").encode()
    assert b" ".join(resample.pieces(text)).split() == text.translate(resample.WORD_BYTES).split()
    for runs in (1, 3):
        known = resample._Buckets(1000)
        pieces = [f for f, _ in resample.features(text, known, runs)]
        monkeypatch.setattr(resample, "PIECE", 1 << 20)
        whole = [f for f, _ in resample.features(text, known, runs)]
        monkeypatch.setattr(resample, "PIECE", 50)
        assert len(pieces) > 5 and len(whole) == 1
        assert sorted(np.concatenate(pieces).tolist()) == sorted(whole[0].tolist())


def test_quickselect_with_ties(spark):
    """A third of the rows have one score, some ids are null, some repeat."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(-(F.col("id") * 37 % 501)).cast("long").alias("lost"), (F.col("id") % 11 == 0).alias("lost_id"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 400).alias("doc_id"), (F.col("id") % 5).alias("n_features"), F.lit(1).cast("long").alias("weight"), F.col("id").alias("row")).persist()
    order = [r["row"] for r in rows.orderBy(*[F.col(c).asc_nulls_first() for c in resample.ORDER]).collect()]
    for k, pivots in ((1, 5), (1700, 24), (2999, 3), (3000, 24)):
        found, rounds = resample.kth_key(rows, k, pivots=pivots)
        assert found["row"] == order[k - 1] and rounds <= 40
    ranked = {r["row"]: r["rank"] for r in resample.ranked(rows.drop("place")).select("row", "rank").collect()}
    assert [ranked[r] for r in order] == list(range(1, 3001))
