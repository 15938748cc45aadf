"""Integer clustering and int8 tiles against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from flowsieve.llm import int8_tiles, walsh

ROW = "vec_id long, embedding array<float>, label int"


# ---------------------------------------------------------------- clustering

def test_transform_is_exact_and_coarse_first():
    x = np.arange(-128, 128).reshape(4, 64)
    t = walsh.transform(x)
    i = np.arange(64)
    hadamard = np.array([[(-1) ** bin(a & b).count("1") for b in i] for a in i])
    assert sorted(map(tuple, (x @ hadamard).T.tolist())) == sorted(map(tuple, t.T.tolist()))
    assert (walsh.restore(t) == x).all() and (t[:, 0] == x.sum(1)).all()
    assert ((t ** 2).sum(1) == 64 * (x ** 2).sum(1)).all()
    changes = [(np.diff(hadamard[:, c]) != 0).sum() for c in walsh.by_sign_changes(64)]
    assert changes == list(range(64))


@pytest.mark.parametrize("top", [40, 1 << 20, 1 << 40])
def test_search_is_exact(top):
    rng = np.random.default_rng(4)
    x, c = rng.integers(-top, top, (300, 64)), rng.integers(-top, top, (8, 64))
    c[5] = c[2]                                          # a tie goes to the smaller number
    x[:50] = c[2] + rng.integers(-3, 4, (50, 64))
    cluster, sums = walsh.search(walsh.transform(x), walsh.transform(c))
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(r, centre)), g) for g, centre in enumerate(c)) for r in x]
    assert [(s // 64, g) for g, s in zip(cluster.tolist(), sums)] == want and 5 not in cluster


def plain_clusters(rows, k=8, rounds=10, salt=3):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{salt}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", walsh.transform(np.array([r[1]]))[0].tolist()))
    centres = [v for _, v in named[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), g) for g, c in enumerate(centres))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for g in range(len(centres)):
            own = [v for (_, v), o in zip(kept, of) if o == g]
            if own:
                centres[g] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, g, d in found if g == h) for h in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, g, d, inertia[g], sum(inertia), names[g]) for i, g, d in found), key=str)


def odd_vectors():
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0.1 * (i % 5), 0.2, 64)], i % 3) for i in range(120)]
    spoiled = [(200, None, 1), (201, [], 1), (202, [0.5] * 63, 1), (203, [0.5] * 63 + [None], 1), (204, [float("nan")] * 64, 1), (205, [float("inf")] + [0.0] * 63, 1)]
    extra = [(300, [0.0] * 64, 0), (301, [-0.0] * 64, 0), (7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], 0), (None, [0.25] * 64, 0), (302, rows[10][1], None), (303, [3e4] * 64, 0)]
    return rows + spoiled + extra


def test_clusters_are_the_plain_ones(spark):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "'x' AS cluster", "1 AS coef", "2 AS distance").repartition(5)
    got = sorted((tuple(r) for r in walsh.clustered(df).collect()), key=str)
    assert got == plain_clusters([(i, v) for i, v, _ in rows])


def test_few_vectors_and_none(spark):
    rows = [(i, [float(i)] * 64, 0) for i in range(3)]
    got = sorted(tuple(r) for r in walsh.clustered(spark.createDataFrame(rows, ROW)).collect())
    assert got == plain_clusters([(i, v) for i, v, _ in rows]) and {r[2] for r in got} == {0}
    assert walsh.clustered(spark.createDataFrame([], ROW)).collect() == []
    assert walsh.clustered(spark.createDataFrame([(1, None, 0)], ROW)).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


# ---------------------------------------------------------------- near duplicates

def test_bounds_are_rigorous():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(200, 64)), rng.normal(size=(40, 64)) ** 9, np.eye(64)[:20] * 1e-200, rng.normal(size=(20, 64)) * 1e200])
    x[200:220] = x[:20] + 0.05 * rng.normal(size=(20, 64))
    codes = int8_tiles.Codes(x)
    y = x / np.abs(x).max(axis=1)[:, None]
    exact = (y @ y.T) / np.sqrt((y * y).sum(1)[:, None] * (y * y).sum(1)[None])
    near = codes.products(slice(0, len(x)), codes) * codes.step[:, None] * codes.step[None]
    slack = codes.rest[:, None] + codes.rest[None] + codes.rest[:, None] * codes.rest[None]
    assert (np.abs(near - exact) <= slack + 1e-9).all() and np.median(slack) < 0.02
    for threshold in (0.5, 0.98, 1.0):
        a, b, again = int8_tiles.tile_links(codes, codes, threshold, slice(0, len(x)), True)
        i, j = np.nonzero(np.triu(exact >= threshold, 1))
        clear = np.abs(exact[i, j] - threshold) > 1e-12
        assert set(zip(i[clear], j[clear])) <= set(zip(a, b)) and all(exact[p, q] >= threshold - 1e-12 for p, q in zip(a, b))
    assert again < 0.02 * len(x) ** 2


def plain_links(rows, threshold=0.98):
    able = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) and label is not None for _, v, label in rows]
    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(v) if a else None for (_, v, _), a in zip(rows, able)]
    links = [[j for j in range(n) if j != i and able[i] and able[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out, of = [], {}
    for i in range(n):
        if i not in of:
            open_, seen = [i], {i}
            while open_:
                fresh = set(links[open_.pop()]) - seen
                seen |= fresh
                open_ += fresh
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            of |= dict.fromkeys(seen, min(ids) if ids else None)
        out.append((rows[i][0], len(links[i]), of[i], of[i] is not None and of[i] == rows[i][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_values", [int8_tiles.BLOCK_VALUES, 64 * 64])
def test_links_are_the_plain_ones(spark, block_values):
    """Chains of near copies, exact copies, scaled copies and one label of many blocks."""
    rng = np.random.default_rng(11)
    rows = odd_vectors()
    for i in range(12):
        at = rng.normal(size=64)
        for j in range(rng.integers(2, 40)):
            at = at + 0.09 * rng.normal(size=64) * (j % 3 > 0)
            rows.append((1000 + 100 * i + j, [float(np.float32(x)) for x in at * (1 + j % 2)], 1))
    rows += [(5000 + i, [float(x) for x in v], 1) for i, v in enumerate(rng.normal(size=(150, 16)).astype(np.float32))] + [(6000, [1e30] * 64, 2), (6001, [1e-30] * 64, 2)]
    df = spark.createDataFrame(rows, ROW).selectExpr("*", "'x' AS key", "1 AS n", "2 AS root", "3 AS width").repartition(5)
    got = sorted((tuple(r) for r in int8_tiles.linked_vectors(df, block_values=block_values).collect()), key=str)
    assert got == plain_links(rows)


def test_hot_copies_and_empty_table(spark):
    rows = [(i, [1.0, 2.0, 3.0] + [0.0] * 61, 1) for i in range(3000)] + [(9000, [1.0, 2.0, 3.0] + [0.01] * 61, 1), (9001, [-1.0] * 64, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in int8_tiles.linked_vectors(spark.createDataFrame(rows, ROW)).collect()}
    assert got[0] == (3000, 0, True) and got[2999] == (3000, 0, False) and got[9000] == (3000, 0, False) and got[9001] == (0, 9001, True)
    assert int8_tiles.linked_vectors(spark.createDataFrame([], ROW)).collect() == []


def test_merge_joins_chains():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = 30
        a, b = rng.integers(0, n, 25), rng.integers(0, n, 25)
        root = np.arange(n)
        for part in (slice(0, 10), slice(10, 25)):
            int8_tiles.merge(root, a[part], b[part])
        want = list(range(n))
        for _ in range(n):
            for p, q in zip(a, b):
                want[p] = want[q] = min(want[p], want[q])
        assert root.tolist() == want
