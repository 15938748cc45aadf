from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from flowsieve.llm import vptree

VECTORS = "vec_id long, embedding array<float>, rank string"


def brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = tuple(float(np.float32(x)) for x in v)
            good[i] = min(good.get(i, v), v)
    out = {}
    for q in good:
        if q % 20 == 0:
            scores = []
            for c, v in good.items():
                if c != q and len(v) == len(good[q]):
                    total = 0.0
                    for a, b in zip(good[q], v, strict=True):
                        total += a * b
                    scores.append((-total, c))
            out[q] = [(c, -s) for s, c in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def rows_with_ties(n=700):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 3)).tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(150)]                       # one very common vector
    rows += [(9000, None), (9020, []), (9040, [0.0] * 8), (9060, [float("nan")] * 8), (9080, [None] + [1.0] * 7), (None, [1.0] * 8),
             (9100, [float("inf")] * 8), (40, rows[40][1]), (60, [9.0] * 8), (9120, [1.0, 2.0]), (9140, [2.0, 1.0])]
    return rows


def test_exact_at_factor_one_in_shards_and_blocks(spark):
    rows = rows_with_ties()
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], VECTORS)
    got = found(vptree.nearest(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=100, block_rows=9, leaf=8))
    want = brute(rows, 7)
    assert got == {q: w for q, w in want.items() if w}


def test_fewer_candidates_than_asked_and_empty_tables(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0], ""), (21, [0.5, 0.5], ""), (22, [0.25, 1.0], "")], VECTORS)
    assert found(vptree.nearest(df, F.col("vec_id") % 20 == 0)) == {20: [(21, 0.5), (22, 0.25)]}
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vptree.nearest(df.filter("vec_id > 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_relaxed_pruning_keeps_recall_and_visits_less():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 16))
    x = np.repeat(centres, 50, axis=0) + 0.1 * rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = np.argsort(-(x[:200] @ x.T), axis=1)[:, :20]
    visits, recall = {}, {}
    for factor in (1.0, 0.8):
        tree = vptree.VPTree(x, leaf=32)
        where, _ = tree.search(x[:200], 20, factor)
        visits[factor] = tree.visits
        recall[factor] = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(where, truth, strict=True)])
    assert recall[1.0] == 1.0 and recall[0.8] >= 0.9 and visits[0.8] <= visits[1.0] < 200 * 3000


def test_many_ties_at_the_last_place_go_to_the_smallest_ids(spark):
    """400 distinct vectors tie for one query, far more than the tree keeps; a few better ones stand before them."""
    rows = [(20, [1.0] + [0.0] * 7)] + [(i, [0.0] + [float((i * p) % 13 - 6.5) for p in (1, 2, 3, 5, 7, 11, 17)]) for i in range(1000, 600, -1)]
    rows += [(5000, [0.5] + [1.0] * 7), (5001, [0.25] + [2.0] * 7), (40, [2.0] + [1.0] * 7), (60, [0.0, 1.0] + [0.0] * 6)]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], VECTORS)
    want = brute(rows, 20)
    for shard_rows, leaf in ((10_000, 128), (150, 8)):
        got = found(vptree.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=shard_rows, leaf=leaf))
        assert [i for i, _ in got[20]][:5] == [40, 5000, 5001, 60, 601]
        assert {q: [i for i, _ in w] for q, w in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
