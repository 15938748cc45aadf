"""Exact splits, trees and boosting against plain computations; both routes of a fit give the same model."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowsieve.models import ada, splits
from flowsieve.models.passes import Block, CutJob, LocalPasses, Sketch, Tree
from flowsieve.models.trees import DecisionTree, GradientBoosting, NewtonBoosting, TreeModel, _Classes
from flowsieve.plans import training as tr
from flowsieve.schema import FEATURES

N = len(FEATURES)


def sample(n: int, seed: int = 3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, N))
    x[:, 3], x[:, 4] = np.round(x[:, 3], 1), rng.integers(0, 4, n)
    y = (x[:, 0] + 0.5 * x[:, 3] + 0.4 * rng.normal(size=n) > 0.2).astype(int)
    return x, y


def frame(spark, x, y, parts: int = 4):
    pdf = pd.DataFrame(x, columns=FEATURES)
    pdf.insert(0, "y", y)
    pdf.insert(0, "row_id", [f"r{i:05d}" for i in range(len(y))])
    schema = "row_id STRING, y INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES)
    return spark.createDataFrame(pdf.astype(object).where(pd.notna(pdf), None), schema).repartition(parts)


def plain_tree(x, t, depth, worth, leaf, stop):
    """Nested (feature, cut, left, right, value): every boundary of every feature, first of the best."""
    node = {"value": leaf(t)}
    if depth == 0 or len(x) < 2 or stop(t):
        return node
    best = None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        for i in np.flatnonzero(v[1:] > v[:-1]):
            score = worth(t[order[:i + 1]]) + worth(t[order[i + 1:]])
            if best is None or score > best[0] + 1e-11 * abs(score):
                best = (score, f, v[i] / 2 + v[i + 1] / 2)
    if best is None:
        return node
    side = x[:, best[1]] <= best[2]
    return node | {"feature": best[1], "cut": best[2], "left": plain_tree(x[side], t[side], depth - 1, worth, leaf, stop),
                   "right": plain_tree(x[~side], t[~side], depth - 1, worth, leaf, stop)}


def plain_values(node, x):
    out = np.empty(len(x))
    for i, row in enumerate(x):
        at = node
        while "feature" in at:
            at = at["left"] if row[at["feature"]] <= at["cut"] else at["right"]
        out[i] = at["value"]
    return out


def same(tree: Tree, node: dict, at: int = 0) -> None:
    assert tree.value[at] == pytest.approx(node["value"], abs=1e-9)
    if "feature" not in node:
        assert tree.feature[at] == -1
        return
    assert (tree.feature[at], tree.cut[at]) == (node["feature"], pytest.approx(node["cut"], abs=1e-12))
    same(tree, node["left"], tree.left[at])
    same(tree, node["right"], tree.left[at] + 1)


def gini_worth(y):
    return (np.sum(y == 0) ** 2 + np.sum(y == 1) ** 2) / len(y)


@pytest.mark.parametrize(("n", "zoom"), [(700, 64), (700, 3), (40, 64)])
def test_tree_is_plain_cart(n, zoom, monkeypatch):
    """700 rows leave several values in a cell, 3 cells to a cell force several passes into it."""
    monkeypatch.setattr(splits, "ZOOM", zoom)
    x, y = sample(n)
    blocks = [Block(x[i::3], y[i::3].astype(float), np.zeros(len(y[i::3]))) for i in range(3)]
    passes = LocalPasses(blocks)
    coarse = [np.quantile(x[:, f], [0.2, 0.5, 0.8]) for f in range(N)]     # few cells: most boundaries lie inside one
    for cuts in (splits.exact_cuts(passes), coarse):
        tree = splits.grow(passes, _Classes(), cuts, 4, splits.Gini.value)
        same(tree, plain_tree(x, y, 4, gini_worth, lambda t: t.mean(), lambda t: t.min() == t.max()))


def test_ties_take_the_first_feature_and_cut():
    x = np.zeros((8, N))
    x[:, 2] = x[:, 7] = [0, 0, 1, 1, 2, 2, 3, 3]
    y = np.array([0, 0, 1, 1, 1, 1, 0, 0])
    tree = splits.grow(LocalPasses([Block(x, y.astype(float), np.zeros(8))]), _Classes(), [np.array([1.5])] * N, 1, splits.Gini.value)
    assert (tree.feature[0], tree.cut[0]) == (2, 0.5)


def test_bounds_hold():
    """No boundary inside a cell is worth more than the cell's bound."""
    rng = np.random.default_rng(5)
    for _ in range(300):
        r = rng.uniform(-1, 1, rng.integers(2, 12)) * rng.uniform(0.1, 1)
        stats = splits.Residual.stats(r, np.abs(r))
        i, j = sorted(rng.integers(0, len(r) + 1, 2))
        total, before, cell = stats.sum(0), stats[:i].sum(0), stats[i:j].sum(0)
        bound = splits.Residual.bound(before[None], cell[None], total, np.array([r.min(), r.max()]))[0]
        inside = stats[i:j][rng.permutation(j - i)]
        for m in range(j - i + 1):
            assert splits.Residual.score((before + inside[:m].sum(0))[None], total)[0] <= bound + 1e-9
        g = splits.Gini.stats((r > 0).astype(float), np.abs(r))
        total, before, cell = g.sum(0), g[:i].sum(0), g[i:j].sum(0)
        bound = splits.Gini.bound(before[None], cell[None], total, np.zeros(2))[0]
        assert all(splits.Gini.score((before + g[i:i + m].sum(0))[None], total)[0] <= bound + 1e-9 for m in range(j - i + 1))


def test_both_routes_of_a_fit(spark):
    x, y = sample(900)
    df = frame(spark, x, y).persist()
    shape = lambda m: [(t.feature, t.cut, t.left, np.round(t.value, 9).tolist()) for t in m.trees]
    for fit in (lambda rows: DecisionTree.fit(df, depth=4, local_rows=rows), lambda rows: GradientBoosting.fit(df, rounds=2, depth=2, local_rows=rows),
                lambda rows: NewtonBoosting.fit(df, rounds=11, depth=2, local_rows=rows)):
        assert shape(fit(10_000)) == shape(fit(100))
    one, many = (ada.AdaBoost.fit(df, rounds=3, local_rows=rows).params["stumps"] for rows in (10_000, 100))
    assert [(s["feature"], s["cut"], s["left"], s["right"]) for s in one] == [(s["feature"], s["cut"], s["left"], s["right"]) for s in many]
    assert [s["alpha"] for s in one] == pytest.approx([s["alpha"] for s in many])


def test_gradient_boosting_is_the_plain_one(spark):
    x, y = sample(500)
    model = GradientBoosting.fit(frame(spark, x, y), rounds=3, depth=3)
    m = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-m))
        t = np.stack([y - p, p * (1 - p)], axis=1)
        plain = plain_tree(x, t, 3, lambda t: t[:, 0].sum() ** 2 / len(t), lambda t: t[:, 0].sum() / t[:, 1].sum(), lambda t: t[:, 0].var() < 1e-15)
        m = m + 0.1 * plain_values(plain, x)
        assert tree.values(x) == pytest.approx(plain_values(plain, x), abs=1e-9)
    got = {r["row_id"]: r["proba"] for r in model.score(frame(spark, x, y)).collect()}
    assert [got[f"r{i:05d}"] for i in range(len(y))] == pytest.approx((1 / (1 + np.exp(-m))).tolist(), abs=1e-9)


def plain_newton(x, g, h, depth, cuts):
    node = {"value": -g.sum() / (h.sum() + 1)}
    worth = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1)
    every, best = np.ones(len(g), bool), None
    for f in range(x.shape[1]):
        for missing_left in (True, False):
            for c in cuts[f]:
                left = np.where(np.isnan(x[:, f]), missing_left, x[:, f] <= c)
                if h[left].sum() >= 1 and h[~left].sum() >= 1:
                    gain = worth(left) + worth(~left) - worth(every)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9 * gain):
                        best = (gain, f, c, missing_left, left)
    if depth and best:
        left = best[4]
        node |= {"f": best[1], "c": best[2], "missing_left": best[3], "left": plain_newton(x[left], g[left], h[left], depth - 1, cuts),
                 "right": plain_newton(x[~left], g[~left], h[~left], depth - 1, cuts)}
    return node


def newton_value(node, row):
    while "f" in node:
        v = row[node["f"]]
        node = node["left"] if (node["missing_left"] if np.isnan(v) else v <= node["c"]) else node["right"]
    return node["value"]


def test_second_order_boosting_is_the_plain_one(spark):
    """500 rows with missing values, whose side is learned."""
    x, y = sample(500, 8)
    rng = np.random.default_rng(2)
    x[(rng.random(500) < 0.3) & (y == 1), 0] = np.nan
    x[rng.random(500) < 0.2, 3] = np.nan
    df = frame(spark, x, y)
    model = NewtonBoosting.fit(df, rounds=2, depth=3)
    cuts = []
    for f in range(N):
        v = np.sort(x[np.isfinite(x[:, f]), f])
        distinct, counts = np.unique(v, return_counts=True)
        cum = np.cumsum(counts)
        ends = range(len(distinct) - 1) if len(distinct) <= 256 else sorted({int(np.argmax(cum * 256 >= k * len(v))) for k in range(1, 256)} - {len(distinct) - 1})
        cuts.append([np.nextafter(distinct[i + 1], -np.inf) for i in ends])
    m = np.full(500, 4 * (y.mean() - 0.5))
    sides = set()
    for tree in model.trees:
        p = 1 / (1 + np.exp(-m))
        plain = plain_newton(x, p - y, p * (1 - p), 3, cuts)
        want = np.array([newton_value(plain, row) for row in x])
        assert tree.values(x) == pytest.approx(want, abs=1e-9)
        sides |= {(f, s) for f, s in zip(tree.feature, tree.missing_left) if f == 0}
        m = m + 0.1 * want
    assert (0, False) in sides          # missing values of the first feature go with the attacks, on the right
    got = {r["row_id"]: r["proba"] for r in model.score(df).collect()}
    assert [got[f"r{i:05d}"] for i in range(500)] == pytest.approx((1 / (1 + np.exp(-m))).tolist(), abs=1e-9)


def test_sketch_is_mergeable():
    rng = np.random.default_rng(9)
    v, w = rng.lognormal(size=20_000), rng.uniform(0.1, 1, 20_000)
    parts = [Sketch(v[i::16], w[i::16], 500) for i in range(16)]
    job = CutJob(64)
    total = {0: parts[0]}
    for part in parts[1:]:
        total = job.merge(total, {0: part})
    assert sorted(total) == [4]          # sixteen equal parts, merged pairwise
    whole = total[4]
    assert len(whole.values) <= 500 and whole.weights.sum() == pytest.approx(w.sum())
    order = np.argsort(v)
    share = np.cumsum(w[order]) / w.sum()
    for value, reached in zip(whole.values, np.cumsum(whole.weights) / w.sum()):
        assert abs(share[np.searchsorted(v[order], value, side="right") - 1] - reached) <= 5 / 500
    exact = Sketch(v, w, 1 << 15)
    assert len(exact.values) == 20_000
    cuts = exact.cuts(64)
    inside = np.diff(np.concatenate([[0], [share[np.searchsorted(v[order], c, side="right") - 1] for c in cuts], [1]]))
    assert len(cuts) == 63 and inside.max() < 1 / 64 + 1e-3
    assert len(Sketch(np.ones(9), np.ones(9), 4).cuts(8)) == 0


def test_one_class_and_no_rows(spark):
    x, _ = sample(20)
    one = frame(spark, x, np.ones(20, int))
    tree = DecisionTree.fit(one, depth=3)
    assert tree.trees[0].feature == [-1] and tree.trees[0].value == [1.0]
    for fit in (GradientBoosting.fit, NewtonBoosting.fit):
        with pytest.raises(ValueError, match="both classes"):
            fit(one)
    with pytest.raises(ValueError, match="no training rows"):
        DecisionTree.fit(one.limit(0))


def test_missing_values_go_right_in_exact_trees(spark):
    x, y = sample(60)
    x[y == 1, 0] = np.nan
    model = DecisionTree.fit(frame(spark, x, y), depth=1)
    assert model.trees[0].feature[0] == 0 and model.score(frame(spark, x, y)).filter("y <> pred").isEmpty()


def test_saved_trees_score_alike(spark, tmp_path):
    x, y = sample(200)
    df = frame(spark, x, y)
    for model in (DecisionTree.fit(df, depth=5), NewtonBoosting.fit(df, rounds=3, depth=3)):
        model.save(spark, str(tmp_path / model.code))
        again = type(model).load(spark, str(tmp_path / model.code))
        assert isinstance(again, TreeModel) and again.code == model.code
        both = model.score(df).select("row_id", "proba").exceptAll(again.score(df).select("row_id", "proba"))
        assert both.isEmpty()


def test_cut_trees_are_the_shallow_fits(spark):
    x, y = sample(300)
    df = frame(spark, x, y)
    whole = DecisionTree.fit(df, depth=None)
    assert whole.score(df).filter("y <> pred").isEmpty()
    for depth in (1, 3, 6):
        shallow, cut = DecisionTree.fit(df, depth=depth).trees[0], whole.cut_to(depth).trees[0]
        assert (shallow.feature, shallow.cut, shallow.value) == (cut.feature, cut.cut, cut.value)
    lines = {r["depth"]: r for r in tr.depth_study(df, df, [2, None]).collect()}
    assert lines[-1]["train_acc"] == 100.0 and lines[2]["gap"] == 0.0
    assert lines[2]["train_acc"] == pytest.approx(100 * df.count() ** -1 * DecisionTree.fit(df, depth=2).score(df).filter(F.col("y") == F.col("pred")).count())


def test_masks_find_the_leaves_that_walking_finds():
    """Trees of few and of many exits, lopsided ones, missing and infinite values; sums are added in the order of the trees."""
    rng = np.random.default_rng(5)
    trees = []
    for size in (0, 1, 5, 31, 63, 64, 200, 700):
        tree, leaves = Tree(), [0]
        for _ in range(size):
            at = leaves.pop(rng.integers(len(leaves)) if size % 2 else -1 if len(leaves) > 40 else 0)
            left = tree.split(at, int(rng.integers(15)), float(rng.integers(-8, 8)) / 4, bool(rng.integers(2)), tuple(rng.random(2)))
            leaves += [left, left + 1]
        trees.append(tree)
    x = rng.integers(-10, 10, (1500, 15)) / 4.0
    x[rng.random(x.shape) < 0.1], x[::9, 2], x[::11, 3] = np.nan, np.inf, -np.inf
    model = DecisionTree(trees, 0.3, 0.1)
    exits, value = model.exits
    plain = np.full(len(x), 0.3)
    for tree in trees:
        plain += 0.1 * tree.values(x)
    assert (exits.total(x, value, 0.3) == plain).all()
    assert (exits._leaves(x) == np.stack([tree.descend(x) + root for tree, root in zip(trees, exits.roots)], axis=1)).all()


def test_models_share_one_visit_to_python(run):
    """All models that are scored in Python are scored in one visit, with the values each has by itself."""
    models = {code: run.model(code) for code in ("nb", "dt", "gb", "lr", "xgb", "et", "knn")}
    rows = run.test.limit(300)
    wide = tr.score_all(rows, models)
    assert wide._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    together = wide.toPandas().set_index("row_id").sort_index()
    for code, model in models.items():
        alone = model.score(rows).toPandas().set_index("row_id").sort_index()
        assert (together[f"p_{code}"] == alone["proba"]).all() and (together[f"pred_{code}"] == alone["pred"]).all()
