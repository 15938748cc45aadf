"""Models against direct computations on small tables, and persistence."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowsieve.models import ada, registry
from flowsieve.models.forest import Nodes, average_path
from flowsieve.models.linear_svm import LinearSvm
from flowsieve.models.naive_bayes import NaiveBayes
from flowsieve.models.neighbors import Neighbors, Shard, ball_leaves, nearest
from flowsieve.plans import evaluation as ev
from flowsieve.plans import training as tr
from flowsieve.schema import FEATURES


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, len(FEATURES)))
    y = (x[:, 0] + 0.5 * x[:, 3] > 0.2).astype(int)
    pdf = pd.DataFrame(x, columns=FEATURES)
    pdf.insert(0, "y", y)
    pdf.insert(0, "row_id", [f"r{i:04d}" for i in range(len(pdf))])
    return spark.createDataFrame(pdf, "row_id STRING, y INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES)), x, y


def accuracy(model, df):
    return model.score(df).agg(F.avg((F.col("y") == F.col("pred")).cast("int"))).first()[0]


def test_unknown_code(small):
    with pytest.raises(ValueError):
        registry.fit("nope", small[0])


def test_svm_gradient_vanishes(small):
    df, x, y = small
    model = LinearSvm.fit(df, tolerance=1e-10)
    xb, s = np.hstack([x, np.ones((len(x), 1))]), 2.0 * y - 1
    w = np.append(model.params["weights"], model.params["bias"])
    slack = np.maximum(0, 1 - s * (xb @ w))
    assert np.abs(w - 2 * xb.T @ (slack * s)).max() < 1e-6


@pytest.mark.parametrize(("shard_rows", "leaf"), [(65_536, 256), (65_536, 8), (5, 2), (100, 16)])
def test_knn_against_brute_force(small, shard_rows, leaf):
    """One shard or a hundred, leaves of any size: the same votes; other columns travel along, a row without a feature gets none."""
    df, x, y = small
    model = Neighbors.fit(df, shard_rows=shard_rows, leaf=leaf)
    assert (model.shards == 1) == (shard_rows > 400) and (shard_rows != 5 or model.shards == 100)
    asked = df.withColumn("proba", F.lit("clash")).withColumn("extra", F.struct("y", "row_id"))
    asked = asked.unionByName(asked.limit(1).withColumn("row_id", F.lit("lost")).withColumn(FEATURES[2], F.lit(None).cast("double")))
    got = {r["row_id"]: r for r in model.score(asked).collect()}
    dist = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    votes = y[np.argsort(dist, axis=1, kind="stable")[:, :5]].mean(axis=1)
    assert [got[f"r{i:04d}"]["proba"] for i in range(len(x))] == pytest.approx(votes.tolist())
    assert got["lost"]["proba"] is None and got["lost"]["pred"] is None and got["r0007"]["extra"]["row_id"] == "r0007"


@pytest.mark.parametrize("shard_rows", [65_536, 30])
def test_knn_ties_go_to_the_smallest_row_id(spark, shard_rows):
    """Many rows in the same place with labels by id: the five smallest ids vote."""
    rows = [(f"r{i:03d}", int(i in (0, 2, 4)), *[1.0] * 15) for i in range(200)] + [(f"s{i}", 1, *[float(i)] * 15) for i in range(3, 9)]
    df = spark.createDataFrame(rows, "row_id STRING, y INT, " + ", ".join(f"{f} DOUBLE" for f in FEATURES)).repartition(3)
    got = {r["row_id"]: r["proba"] for r in Neighbors.fit(df, shard_rows=shard_rows, leaf=16).score(df).collect()}
    assert got["r150"] == got["r000"] == 0.6 and got["s8"] == 1.0


def test_knn_fewer_rows_than_neighbours(spark, small):
    df, _, y = small
    few = df.orderBy("row_id").limit(3)
    (got,) = Neighbors.fit(few, shard_rows=2).score(df).select("proba").distinct().collect()
    assert got["proba"] == pytest.approx(y[:3].mean())
    with pytest.raises(ValueError, match="no training rows"):
        Neighbors.fit(df.limit(0))


def test_knn_leaves_are_bounded_by_boxes(small):
    """No member is nearer than its leaf's box; the boxes rule out most leaves that a ball around the centre would not."""
    _, x, y = small
    shard = Shard(x, y, ball_leaves(x, 16))
    low = shard.apart(x)
    for leaf, at in enumerate(shard.leaves):
        dist = ((x[:, None, :] - x[None, at]) ** 2).sum(axis=2).min(axis=1)
        assert (low[leaf] <= dist).all() and (low[leaf, at] == 0).all()
    best, place = shard.search(x, 5)
    assert (place == np.argsort(((x[:, None, :] - x[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :5]).all()


def test_knn_with_one_shard_moves_only_features(small):
    df, _, _ = small
    plan = Neighbors.fit(df).score(df)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan and "Join" not in plan


def test_knn_many_ties():
    train = np.zeros((300, 15))
    _, place, _ = nearest(np.zeros((3, 15)), train, np.arange(300), 5)
    assert place.tolist() == [[0, 1, 2, 3, 4]] * 3


def test_stump_against_brute_force(small):
    df, x, y = small
    stump = ada.AdaBoost.fit(df, rounds=1).params["stumps"][0]

    def gini(mask):
        p = y[mask].mean()
        return mask.sum() * 2 * p * (1 - p)

    values = [np.unique(x[:, f]) for f in range(15)]
    best = min((gini(x[:, f] <= c) + gini(x[:, f] > c), f, c / 2 + d / 2) for f, v in enumerate(values) for c, d in zip(v[:-1], v[1:]))
    assert (stump["feature"], stump["cut"]) == (best[1], pytest.approx(best[2]))


def test_ada_bounds_and_first_rounds(small):
    df, x, y = small
    model = ada.AdaBoost.fit(df, rounds=3)
    first, second = model.params["stumps"][:2]
    side = lambda s: np.where(x[:, s["feature"]] <= s["cut"], s["left"], s["right"])
    miss = side(first) != y
    assert first["error"] == pytest.approx(miss.mean())
    assert first["alpha"] == pytest.approx(np.log((1 - miss.mean()) / miss.mean()))
    weight = np.exp(first["alpha"] * miss)
    assert second["error"] == pytest.approx(weight[side(second) != y].sum() / weight.sum())
    proba = model.score(df).agg(F.min("proba"), F.max("proba")).first()
    assert 0.119 < proba[0] <= proba[1] < 0.881


def test_naive_bayes_against_numpy(small):
    df, x, y = small
    got = {r["row_id"]: r["proba"] for r in NaiveBayes.fit(df).score(df).collect()}
    logs = []
    for c in (0, 1):
        m, v = x[y == c].mean(axis=0), x[y == c].var(axis=0) + 1e-9 * x.var(axis=0).max()
        logs.append(np.log((y == c).mean()) - 0.5 * np.log(2 * np.pi * v).sum() - ((x - m) ** 2 / (2 * v)).sum(axis=1))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert [got[f"r{i:04d}"] for i in range(len(x))] == pytest.approx(want.tolist(), abs=1e-9)


def test_nodes_descend():
    nodes = Nodes([0, -1, 1, -1, -1], [0.5, 0, 2.0, 0, 0], [1, 0, 3, 0, 0], [0, 0.1, 0, 0.2, 0.9], [0])
    x = np.array([[0.5, 0.0], [0.6, 2.0], [0.6, 2.1]])
    assert nodes.mean_value(x).tolist() == [0.1, 0.2, 0.9]


def test_average_path():
    assert average_path(1) == 0 and average_path(2) == 1
    assert float(average_path(256)) == pytest.approx(2 * (np.log(255) + np.euler_gamma) - 2 * 255 / 256)


def test_extra_trees_grow_to_purity(small):
    df, x, y = small
    model = registry.OWN["et"].fit(df, trees=10, depth=15)
    assert accuracy(model, df) > 0.97
    again = registry.OWN["et"].fit(df.repartition(5), trees=10, depth=15)
    assert np.array_equal(model.nodes.cut, again.nodes.cut)
    shallow = registry.OWN["et"].fit(df, trees=4, depth=1)
    assert len(shallow.nodes.feature) == 12


def test_extra_trees_in_passes(small, monkeypatch):
    from flowsieve.models import forest
    monkeypatch.setattr(forest, "SLOTS", 7)
    assert accuracy(registry.OWN["et"].fit(small[0], trees=5, depth=4), small[0]) > 0.8


def test_isolation_forest(spark, small):
    df = small[0]
    model = registry.IsolationForest.fit(df, trees=50)
    share = model.score(df).agg(F.avg("pred")).first()[0]
    assert share == pytest.approx(0.01, abs=0.003)
    far = df.limit(5).select("row_id", "y", *[F.lit(9.0).alias(f) for f in FEATURES])
    assert model.score(far).agg(F.min("pred")).first()[0] == 1


@pytest.mark.parametrize("code", ["dt", "ada", "et", "knn", "lr", "svm", "nb", "rf"])
def test_beats_one_class(run, code):
    """Mean share of hits per class: the test rows are as unbalanced as the flows."""
    hits = run.model(code).score(run.test).groupBy("y").agg(F.avg((F.col("y") == F.col("pred")).cast("int")).alias("hit")).collect()
    assert len(hits) == 2 and sum(r["hit"] for r in hits) / 2 > 0.7


@pytest.mark.parametrize("code", ["dt", "ada", "et", "knn", "svm", "nb", "iforest"])
def test_saved_model_scores_the_same(spark, run, tmp_path, code):
    model = run.model(code)
    registry.save(model, spark, str(tmp_path))
    again = registry.load(code, spark, str(tmp_path))
    a, b = (m.score(run.test).select("row_id", "proba", "pred") for m in (model, again))
    assert a.exceptAll(b).isEmpty() and a.count() == run.test.count()


def test_missing_model_is_an_error(spark, tmp_path):
    for code in ("nb", "et", "dt", "iforest"):
        with pytest.raises(FileNotFoundError):
            registry.load(code, spark, str(tmp_path / "none"))


def test_missing_models_are_skipped(spark, run, sf, tmp_path):
    from flowsieve import fixtures as fx
    run.model("nb")
    folder = str(tmp_path / "m")
    part = tr.TrainingRun(run.rows)
    part.models["nb"] = run.model("nb")
    part.save(spark, folder)
    table = ev.evaluate_external(tr.SavedRun(spark, folder), fx.flows(spark, sf), ["nb", "svm"])
    assert [r["model"] for r in table.collect()] == ["nb"]


@pytest.mark.parametrize("query", ["decision_grid", "availability_quality", "evaluate_external", "evaluate_unlabelled", "train_report"])
def test_a_model_that_fails_is_no_shorter_result(spark, sf, run, monkeypatch, query):
    """A query over all models must not return the lines of the others as if they were all."""
    from flowsieve.plans import model_catalog as mc
    fit = registry.fit
    monkeypatch.setattr(registry, "CODES", ["nb", "svm"])
    monkeypatch.setattr(registry, "fit", lambda code, *a: fit(code, *a) if code == "nb" else 1 / 0)
    monkeypatch.setattr(mc, "training_run", lambda *a: tr.TrainingRun(run.rows))
    with pytest.raises(ZeroDivisionError):
        getattr(mc, query)(spark, sf)


def test_a_saved_model_that_is_lost_is_an_error(spark, run, tmp_path, monkeypatch):
    """What the set was published without is left out; what it names must load."""
    part = tr.TrainingRun(run.rows)
    part.models["nb"] = run.model("nb")
    part.save(spark, str(tmp_path / "m"))
    saved = tr.SavedRun(spark, str(tmp_path / "m"))
    assert list(tr.available(saved, ["nb", "svm"])) == ["nb"]
    lost = tr.SavedRun(spark, str(tmp_path / "m"))
    monkeypatch.setattr(registry, "load", lambda code, *a: (_ for _ in ()).throw(FileNotFoundError(code)))
    with pytest.raises(FileNotFoundError):
        tr.available(lost, ["nb"])
    reasons = {}
    assert not tr.available(lost, ["nb", "svm"], reasons) and set(reasons) == {"nb", "svm"}


def test_cascade_is_inside_both_layers(spark, run):
    scored = ev.cascade_scores(run, run.test)
    assert scored.where("pred = 1 AND (pred1 = 0 OR pred2 = 0)").isEmpty()
    assert scored.where("proba <> least(p1, p2)").isEmpty()
    assert scored.where("(verdict = 1) <> (pred = 1)").isEmpty()
    assert scored.where("verdict = 2 AND anomaly = 0").isEmpty()


def test_reports(spark, run, sf):
    from flowsieve import fixtures as fx
    raw = ev.single_source(run, fx.flows(spark, sf), ["row_id", "copy"], cap=3000)
    report = ev.availability_report(run, raw, ["nb", "dt"])
    assert raw.count() == 3000 and report["quality"].count() == 2
    assert report["sweep"].count() == 200 and report["grid"].count() == 3200
    assert report["points"].groupBy("y").count().collect()
    single = ev.cascade_report(run, raw)
    assert single["quality"].first()["accuracy"] > 90 and single["report"].count() == 5


def test_classes_are_counted_before_rows_are_repeated(spark, run, sf):
    """Quality tables of all models count combinations of classes; no row is repeated for every model."""
    from flowsieve import fixtures as fx
    from flowsieve.operators import metrics as me
    rows = [(i, i % 2, "ab"[i % 2], (i // 3) % 2 if i % 7 else None, (i // 5) % 2, i / 100.0, None) for i in range(100)] + [(100, 0, None, None, None, 0.5, 0.5)]
    wide = spark.createDataFrame(rows, "row_id long, y int, source_file string, pred_a int, pred_b int, p_a double, p_b double")
    for by in ([], ["source_file"]):
        long, counts = me.long_scores(wide, ["a", "b"], [*by, "y"]), me.class_counts(wide, ["a", "b"], [*by, "y"])
        assert sorted(map(str, me.compare_models(long, by).collect())) == sorted(map(str, me.compare_models(counts, by, "rows").collect()))
        assert sorted(map(str, me.prediction_mix(long, [*by, "model"]).collect())) == sorted(map(str, me.prediction_mix(counts, [*by, "model"], "rows").collect()))
    raw = ev.single_source(run, fx.flows(spark, sf), ["row_id", "copy"])
    for table in (ev.evaluate_external(run, fx.flows(spark, sf), ["nb", "dt"]), ev.availability_report(run, raw, ["nb", "dt"], parts=("quality",))["quality"]):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.rindex("HashAggregate") > plan.index("Generate")            # the plan's last lines run first


def test_one_part_of_a_report_writes_nothing(spark, run, sf, monkeypatch):
    """Who asks for the quality table alone pays for one pass over the rows, and gets the same table."""
    from flowsieve import fixtures as fx
    from flowsieve.operators import curves as cu
    raw = ev.single_source(run, fx.flows(spark, sf), ["row_id", "copy"])
    whole = {"availability": ev.availability_report(run, raw, ["nb", "dt"]), "cascade": ev.cascade_report(run, raw, ("nb", "dt"))}
    assert list(whole["availability"]) == list(ev.AVAILABILITY) and list(whole["cascade"]) == list(ev.CASCADE)
    for module in (ev, cu):
        monkeypatch.setattr(module, "materialize", lambda df, purpose="table": pytest.fail(f"{purpose} was written"))
    alone = {"availability": ev.availability_report(run, raw, ["nb", "dt"], parts=("quality",)), "cascade": ev.cascade_report(run, raw, ("nb", "dt"), parts=("quality",))}
    for job, report in alone.items():
        assert list(report) == ["quality"] and sorted(report["quality"].collect()) == sorted(whole[job]["quality"].collect())


def test_a_part_that_does_not_exist_is_an_error(run):
    for report in (ev.availability_report, ev.cascade_report):
        for parts in (("qualty",), ("quality", "areas"), ()):
            with pytest.raises(ValueError, match="parts"):
                report(run, run.rows, parts=parts)


def test_training_writes_distinct_rows_once(run, monkeypatch):
    """Scaled values and test marks are computed from the written rows, not written again."""
    written = []
    monkeypatch.setattr(tr, "materialize", lambda df, purpose="table": written.append((purpose, df.count())) or df)
    again = tr.TrainingRun(run.rows, file_cap=40)
    assert again.test.count() == run.test.count() and sorted(again.scaled.columns) == sorted(run.rows.columns)
    again.train.count()
    rows = dict(written)
    assert set(rows) == {"scaler", "thinned", "balanced"}
    assert rows["thinned"] <= 40 * run.rows.select("source_file").distinct().count()


def test_scored_rows_are_those_of_the_training_run(spark, run, sf):
    """The single-model queries do not drop duplicates a second time."""
    from flowsieve.plans import model_catalog as mc
    plan = mc.all_scaled(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "HashAggregate" not in plan


def test_depth_study(run):
    table = tr.depth_study(run.train, run.test, [1, None]).toPandas()
    assert table.depth.tolist() == [1, -1] and (table.train_acc.diff().dropna() > 0).all()


def test_every_test_row_is_judged_whatever_the_cap(run):
    """The cap per source thins the training side only."""
    capped = tr.TrainingRun(run.rows, file_cap=40, cap=100)
    rows = run.rows.count()
    assert capped.test.count() == run.test.count() == -(-rows // 5)
    sources = run.rows.select("source_file").distinct().count()
    assert 0 < capped.train.count() <= 40 * sources < run.train.count()
    assert capped.train.join(capped.test, "row_id").isEmpty() and set(capped.test.columns) == {"row_id", "y", *FEATURES}


def test_train_all_fits_on_every_training_row(spark, monkeypatch):
    """No cap, neither per source nor in all, thins what its models are fitted on; classes are still balanced."""
    from flowsieve.plans import model_catalog as mc
    values = ", ".join(f"CAST(id % {97 + i} AS DOUBLE) AS {f}" for i, f in enumerate(FEATURES))
    rows = spark.sql(f"SELECT concat('r', id) AS row_id, CAST(id % 20 < 9 AS INT) AS y, if(id < 59000, 'a.csv', 'b.csv') AS source_file, {values} FROM range(60000)")
    monkeypatch.setattr(mc, "training_run", lambda *a: tr.TrainingRun(rows))
    monkeypatch.setattr(tr, "compare_on_test", lambda run, codes: (run, codes))
    run, codes = mc.train_all(spark, "generated rows")
    left = run.split.where("NOT is_test").groupBy("y").count().toPandas()["count"]
    assert codes == registry.CODES and left.sum() == 48_000 and run.train.count() == 2 * left.min() > 40_000
    assert run.train.groupBy("y").count().select("count").distinct().count() == 1 and run.test.count() == 12_000


def test_copies_in_several_sources_are_one_row(spark):
    values = ", ".join(f"CAST(id % 5 + {i} AS DOUBLE) AS {f}" for i, f in enumerate(FEATURES))
    flows = spark.sql(f"SELECT concat('r', id) AS row_id, concat('s', id % 3, '.csv') AS source_file, 'BENIGN' AS label, {values} FROM range(60)")
    rows = tr.training_rows(flows, ("row_id", "source_file")).collect()
    assert len(rows) == 5 and len({r["row_id"] for r in rows}) == 5 and {r["source_file"] for r in rows} == {"s0.csv"}
    plain = tr.training_rows(flows.drop("source_file", "row_id")).collect()
    assert {r["row_id"] for r in plain} == {r["row_id"] for r in rows} and {r["source_file"] for r in plain} == {None}


def test_model_sets_are_published_whole(spark, run, tmp_path, monkeypatch):
    """A save that dies half way leaves the version before in force; a job keeps the version it began with."""
    folder = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        tr.SavedRun(spark, folder)
    part = tr.TrainingRun(run.rows)
    part.models["nb"] = run.model("nb")
    first = part.save(spark, folder)
    live = tr.SavedRun(spark, folder)
    assert (live.version, live.saved) == (first, ["nb"])

    part.models["ada"] = run.model("ada")
    save = registry.save
    monkeypatch.setattr(registry, "save", lambda model, *a: save(model, *a) if model.code == "nb" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        part.save(spark, folder)
    assert tr.SavedRun(spark, folder).version == first
    monkeypatch.undo()
    second = part.save(spark, folder)
    assert tr.SavedRun(spark, folder).version == second and tr.SavedRun(spark, folder, first).version == first
    assert live.model("nb").params == run.model("nb").params
    with pytest.raises(FileNotFoundError):
        live.model("ada")
    assert [r["number"] for r in tr.manifest(spark, folder).orderBy("number").collect()] == [1, 2]

    tr.publish(spark, folder, second, {f: (1.0, 2.0) for f in FEATURES}, ["nb"])
    with pytest.raises(ValueError, match="another scaler"):
        tr.SavedRun(spark, folder)
