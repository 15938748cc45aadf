"""Hand-worked values for labels, file names, rates and thresholds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowsieve import functions as fn
from flowsieve.operators import cascade as ca
from flowsieve.operators import cleaning as cl
from flowsieve.operators import metrics as me


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,y", [("BENIGN", 0), (" benign ", 0), ("\tbenign\n", 0), ("0", 0), ("Normal", 0), (" benign", 0),
                                    ("0.0", 1), ("DDoS-Attack", 1), (" PortScan", 1), ("", 1), (None, 1)])
def test_binarize(spark, text, y):
    assert one(spark, fn.binarize(F.lit(text).cast("string"))) == y


def test_binarize_numbers(spark):
    assert one(spark, fn.binarize(F.lit(0))) == 0
    assert one(spark, fn.binarize(F.lit(0.0))) == 1


@pytest.mark.parametrize("name,family", [
    ("Thursday-Morning-WebAttacks.csv", "Web Attacks (SQL/XSS/BF)"), ("Friday-Morning.csv", "Botnet"),
    ("Monday-WorkingHours.csv", "Benign"), ("Friday-Afternoon-DDos.csv", "DDoS"), ("TUESDAY.csv", "Patator (FTP/SSH)"),
    ("Wednesday-portscan.csv", "PortScan"), ("Thursday-Afternoon-Infilteration.csv", "Infiltration")])
def test_attack_family(spark, name, family):
    assert one(spark, fn.attack_family(F.lit(name))) == family


def test_rates_guard_zero(spark):
    assert one(spark, fn.guarded_rate(F.lit(10), F.lit(0))) == 0.0
    assert one(spark, fn.guarded_rate(F.lit(10), F.lit(2_000_000))) == 5.0
    assert one(spark, fn.percent(F.lit(1), F.lit(0), 100.0)) == 100.0


def test_min_proba_keeps_null(spark):
    assert one(spark, fn.min_proba(F.lit(0.4), F.lit(0.9))) == 0.4
    assert one(spark, fn.min_proba(F.lit(None).cast("double"), F.lit(0.9))) is None


def test_sigmoid_extremes(spark):
    assert one(spark, fn.sigmoid(F.lit(0.0))) == 0.5
    assert one(spark, fn.sigmoid(F.lit(-1e9))) == pytest.approx(0.0)
    assert one(spark, fn.sigmoid(F.lit(1e9))) == pytest.approx(1.0)


def test_sensitivity(spark):
    assert one(spark, fn.step(F.lit(0.03), 1)) == 0.0
    assert one(spark, fn.step(F.lit(0.97), -1)) == 1.0
    assert [one(spark, fn.band(F.lit(t))) for t in (0.29, 0.3, 0.59, 0.6)] == ["very high", "medium", "medium", "low"]


def test_bayes_golden(spark):
    rated = spark.createDataFrame([(99.87, 96.2, 3.8)], "recall DOUBLE, tnr DOUBLE, fpr DOUBLE")
    row = me.with_bayes(rated).first()
    assert row["bayes_01"] == pytest.approx(2.5634, abs=1e-4)
    assert row["bayes_50"] == pytest.approx(58.0403, abs=1e-4)


def test_one_class_and_empty(spark):
    only = spark.createDataFrame([(1, 1), (1, 0)], "y INT, pred INT")
    cm = me.confusion(only)
    assert tuple(cm.first()) == (0, 0, 1, 1)
    assert me.rates(cm).first()["tnr"] == 0.0
    assert me.rates(cm, empty_tnr=100.0).first()["tnr"] == 100.0
    assert tuple(me.confusion(only.where("y = 5")).first()) == (0, 0, 0, 0)
    assert me.rates(me.confusion(only.where("y = 5"))).first()["accuracy"] == 0.0


def test_cascade_literals(spark):
    df = spark.createDataFrame([(.9, .4, 0), (.5, .5, 1), (.4, .9, 1), (.9, .9, 1)], "p1 DOUBLE, p2 DOUBLE, anomaly INT")
    assert [r["pred"] for r in ca.cascade_threshold(df).collect()] == [0, 1, 0, 1]
    assert [r["proba"] for r in ca.cascade_proba(df).collect()] == [.4, .5, .4, .9]
    classes = df.withColumns({"pred1": ca.predict_class(F.col("p1")), "pred2": ca.predict_class(F.col("p2"))})
    assert [r["verdict"] for r in ca.cascade_detailed(classes).collect()] == [0, 2, 2, 1]
    assert [r["verdict"] for r in ca.cascade_detailed(classes, None).collect()] == [0, 0, 0, 1]


def test_downsize_bounds(spark):
    df = spark.createDataFrame([(1, 1, 1, 2**40, 1.5), (126, 127, 32767, 0, 2.0)], "a INT, b INT, c INT, d LONG, e DOUBLE")
    chosen = {r["column"]: r["chosen"] for r in cl.downsize(df).collect()}
    assert chosen == {"a": "int8", "b": "int16", "c": "int32", "d": "int64", "e": "float32"}
    assert dict(cl.apply_downsize(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float"}


def test_whole_numbers_stay_exact(spark):
    df = spark.createDataFrame([(119_999_998.0, 0.1), (16_777_217.0, 119_999_998.5)], "flow_duration DOUBLE, flow_iat_mean DOUBLE")
    rows = cl.model_types(df).collect()
    assert [r["flow_duration"] for r in rows] == [119_999_998.0, 16_777_217.0]
    assert [r["flow_iat_mean"] for r in rows] == [0.10000000149011612, 120_000_000.0]


def test_drop_non_finite_looks_at_every_column(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, "a"), (inf, "a"), (-inf, "a"), (float("nan"), "a"), (None, "a"), (1.0, None)], "x DOUBLE, s STRING")
    assert cl.drop_non_finite(df).count() == 1
    assert cl.drop_non_finite(df, subset=["x"]).count() == 2


def test_labels_by_exact_name(spark):
    make = lambda *names: spark.createDataFrame([tuple(range(len(names)))], list(names))
    assert cl.find_label(make("class", "Label")) == "Label"
    assert cl.find_label(make("x", "LABEL")) is None
    assert "y" not in cl.with_target(make("x")).columns


def test_clean_columns_collision(spark):
    with pytest.raises(ValueError):
        cl.clean_columns(spark.createDataFrame([(1, 2)], ["a", " a "]))


def test_conform(spark):
    df = spark.createDataFrame([(5,)], "flow_duration INT")
    row = cl.conform(df).first()
    assert row["flow_duration"] == 5.0 and row["flow_iat_max"] == 0.0
    with pytest.raises(ValueError):
        cl.conform(df, strict=True)


def test_dedup_is_idempotent_and_ids_unique(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (2, "a", 2)], "x INT, s STRING, tag INT")
    once = cl.drop_duplicates(df, ("tag",))
    assert once.count() == 2 == cl.drop_duplicates(once).count()
    ids = cl.with_row_id(once)
    assert ids.select("row_id").distinct().count() == 2
    assert {r["row_id"] for r in ids.collect()} == {r["row_id"] for r in cl.with_row_id(once.repartition(5)).collect()}
