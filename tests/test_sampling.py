"""Exact sizes, determinism, and the routes for large data forced onto small tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsieve.operators import cleaning as cl
from flowsieve.operators import curves as cu
from flowsieve.operators import sampling as sa
from flowsieve.operators import scaling as sc
from flowsieve.operators.quantile import exact_quantile
from flowsieve.schema import FEATURES
from flowsieve.session import attach, bounded_table


@pytest.fixture(scope="module")
def rows(spark):
    """A skewed table: group 0 holds 90 % of the rows."""
    return spark.range(20_000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y"))


@pytest.mark.parametrize("n", [0, 1, 7, 1999, 2000, 2001, 20_000, 50_000])
def test_group_sizes_are_exact(rows, n):
    got = {r["y"]: r["count"] for r in sa.sample_n(rows, n, ["row_id"], by="y").groupBy("y").count().collect()}
    assert got == {y: k for y, k in ((0, min(n, 18_000)), (1, min(n, 2_000))) if k}


@pytest.mark.parametrize("n", [1, 7, 2000, 9999])
def test_refined_cut_equals_plain_cut(rows, monkeypatch, n):
    """With one row per ranking task, every bucket has to be refined down to single draws."""
    plain = sa.sample_n(rows, n, ["row_id"], by="y")
    want = plain.collect()
    monkeypatch.setattr(sa, "RANKED_ROWS", 1)
    assert sorted(want) == sorted(sa.sample_n(rows, n, ["row_id"], by="y").collect())


def test_only_rows_near_a_cut_are_written(rows, monkeypatch):
    """One bucket of 4,096 per group, not a draw for every row."""
    written, write = [], sa.materialize
    monkeypatch.setattr(sa, "materialize", lambda df, purpose="table": written.append(df.count()) or write(df, purpose))
    assert sa.sample_n(rows, 700, ["row_id"], by="y").count() == 1400
    assert len(written) == 1 and 2 <= written[0] < 100
    assert sa.sample_n(rows, 50_000, ["row_id"], by="y").count() == 20_000 and len(written) == 1


def test_distinct_rows_are_dealt_by_content(spark):
    """Mostly distinct rows meet their copies in one shuffle without a map-side aggregate; often copied ones collapse first."""
    few = spark.sql("SELECT id % 1000 AS a, concat('s', id % 7) AS tag, CAST(id % 1000 AS DOUBLE) AS v FROM range(1500)")
    dealt = cl.dealt_by_row(few, ("tag",), 100)
    plan = cl.drop_duplicates(dealt, ("tag",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan.split("Exchange")[1]
    assert cl.drop_duplicates(dealt, ("tag",)).count() == 1000
    copied = few.where("a < 100").unionAll(few.where("a < 100")).unionAll(few.where("a < 100"))
    assert cl.dealt_by_row(copied, ("tag",), 100) is copied and cl.dealt_by_row(few, ("tag",)) is few


def test_rows_that_occur_once_are_not_shuffled(spark):
    """Only hashes and rows that may occur again leave their task; copies, crowded bitmaps and sources as when compared whole."""
    once = spark.range(3000).selectExpr("id AS a", "CASE WHEN id % 5 > 0 THEN concat('s', id) END AS `b.c`", "id % 3 AS tag", "concat('f', id % 4) AS source_file")
    plan = cl.distinct_by_hash(once, ("tag",), 100)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.index("Union") < plan.index("Aggregate")
    some = once.unionAll(once.where("a % 10 = 0").withColumn("tag", F.lit(7)).withColumn("source_file", F.lit("e")))
    for table, ignore, places in ((some, ("tag",), cl.HASH_PLACES), (some, ("tag", "source_file"), 1 << 9), (some.unionAll(once), ("tag",), 1 << 9),
                                  (some.drop("source_file"), ("tag",), cl.HASH_PLACES), (some.where("a < 50"), ("tag",), 1 << 9)):
        got, want = cl.distinct_by_hash(table, ignore, 100, places), cl.distinct_of_sources(table, ignore)
        assert got.count() == want.count() and got.select([f"`{c}`" for c in want.columns]).exceptAll(want).isEmpty()


def test_sample_does_not_depend_on_layout(rows):
    ids = lambda df: sorted(r["row_id"] for r in sa.sample_n(df, 500, ["row_id"]).select("row_id").collect())
    assert ids(rows) == ids(rows.repartition(13))
    other = sorted(r["row_id"] for r in sa.sample_n(rows, 500, ["row_id"], seed=7).collect())
    assert ids(rows) != other


def test_sample_is_even(rows):
    mean = sa.sample_n(rows, 5000, ["row_id"]).agg(F.avg("row_id")).first()[0]
    assert abs(mean - 10_000) < 350


def test_undersample(rows):
    counts = lambda df: sa.class_counts(df)
    assert counts(sa.undersample(rows, ["row_id"])) == (2000, 2000)
    assert counts(sa.undersample(rows, ["row_id"], ratio=2.5)) == (5000, 2000)
    assert counts(sa.undersample(rows, ["row_id"], strategy="none")) == (18_000, 2000)
    assert counts(sa.undersample(rows.where("y = 1"), ["row_id"])) == (0, 2000)
    with pytest.raises(ValueError):
        sa.undersample(rows, ["row_id"], ratio=100.0)


def test_cap_keeps_a_short_class_whole(rows):
    assert sa.class_counts(sa.stratified_cap(rows, 10_000)) == (5000, 2000)
    assert sa.class_counts(sa.stratified_cap(rows, 20_000)) == (18_000, 2000)


def test_split_is_a_partition(rows):
    train, test = sa.train_test_split(rows.where("row_id < 1003"))
    assert (train.count(), test.count()) == (802, 201)
    assert train.join(test, "row_id").isEmpty()


def test_steps_draw_independently(rows):
    """Balancing must not decide the split: both classes keep their share on the test side."""
    _, test = sa.train_test_split(sa.undersample(rows, ["row_id"]))
    benign, attack = sa.class_counts(test)
    assert benign + attack == 800 and abs(benign - attack) < 100


def test_rows_without_a_group_are_kept(rows):
    unnamed = rows.withColumn("name", F.when(F.col("row_id") % 2 == 0, "even"))
    got = {r["name"]: r["count"] for r in sa.sample_n(unnamed, 30, ["row_id"], by="name").groupBy("name").count().collect()}
    assert got == {"even": 30, None: 30}


def test_empty_input(rows):
    assert sa.sample_n(rows.where("y = 9"), 5, ["row_id"]).count() == 0


def test_attach_beyond_the_broadcast_limit(spark, rows):
    side = rows.groupBy("y").count()
    small, large = attach(rows, side, ["y"]), attach(rows, side, ["y"], limit=1)
    assert small.exceptAll(large).isEmpty() and large.count() == 20_000
    assert bounded_table(side, 1).inputFiles()


def test_scaled_columns_are_standard(spark, run):
    scaled = sc.scaler_apply(run.rows, run.params)
    stats = scaled.agg(*[fn(f).alias(f"{t}_{f}") for f in FEATURES for t, fn in (("m", F.avg), ("s", F.stddev_pop))]).first()
    for f in FEATURES:
        assert stats[f"m_{f}"] == pytest.approx(0.0, abs=1e-9)
        assert stats[f"s_{f}"] == pytest.approx(0.0 if f == "bwd_len_mean" else 1.0, abs=1e-9)


def test_scaling_drops_duplicates_once(spark, sf):
    """The scaled rows are read as they were written for the fit, not found a second time."""
    from flowsieve.plans import catalog
    scaled = catalog.scaler_apply(spark, sf)
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "HashAggregate" not in plan
    assert scaled.count() == catalog.distinct_flows(spark, sf).count() == scaled.select("row_id").distinct().count()


@pytest.fixture(scope="module")
def scored(spark):
    p = F.round(F.abs(F.sin(F.col("id"))), 3)
    return spark.range(5000).select(F.col("id").alias("row_id"), (F.hash("id") % 2 == 0).cast("int").alias("y"), p.alias("proba"))


def test_partitioned_curves_equal_single_task_curves(scored):
    for curve in (cu.roc_curve, cu.pr_curve):
        one, many = curve(scored), curve(scored, single_task_rows=0)
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    assert cu.roc_auc(scored).first()["auc"] == pytest.approx(cu.roc_auc(scored, single_task_rows=0).first()["auc"])


def test_auc_by_pairs_and_under_monotone_maps(scored):
    data = scored.limit(400).toPandas()
    pos, neg = data[data.y == 1].proba.to_numpy(), data[data.y == 0].proba.to_numpy()
    wins = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
    few = scored.sparkSession.createDataFrame(data)
    assert cu.roc_auc(few).first()["auc"] == pytest.approx(wins)
    assert cu.roc_auc(few.withColumn("proba", F.pow("proba", 3))).first()["auc"] == pytest.approx(wins)
    assert cu.roc_auc(few.where("y = 1")).first()["auc"] is None


def test_sweep_against_numpy(scored):
    data = scored.toPandas()
    sweep = cu.threshold_sweep(scored).toPandas().sort_values("i")
    thresholds = np.array([i * (1.0 / 99) for i in range(99)] + [1.0])
    assert np.array_equal(sweep.threshold.to_numpy(), thresholds)
    for t, recall, tnr in zip(thresholds, sweep.recall, sweep.tnr):
        pred = data.proba >= t
        assert recall == pytest.approx(100 * pred[data.y == 1].mean()) and tnr == pytest.approx(100 * (~pred)[data.y == 0].mean())
    assert sweep.recall.is_monotonic_decreasing and sweep.tnr.is_monotonic_increasing


def test_sweep_at_the_thresholds_themselves(spark):
    """Scores that equal a threshold must count at it, whatever the rounding."""
    rows = [(1, i * (1.0 / 99)) for i in range(99)] + [(1, 1.0), (0, 0.0)]
    sweep = cu.threshold_sweep(spark.createDataFrame(rows, "y INT, proba DOUBLE")).toPandas().sort_values("i")
    assert sweep.recall.round(9).tolist() == [float(100 - i) for i in range(100)]


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, q):
    values = spark.range(3000).select((F.pow(F.col("id") % 997, 3) / 7.0).alias("v"))
    want = np.quantile(values.toPandas().v, q)
    assert exact_quantile(values, "v", q) == pytest.approx(want)
    assert exact_quantile(values, "v", q, small=10) == pytest.approx(want)


def test_refined_route_is_exact_for_every_size(spark):
    """Two skewed groups, one row per ranking task: every bucket is refined, also those needed in full."""
    few = spark.range(330).select(F.col("id").alias("row_id"), F.when(F.col("id") % 11 == 0, 1).otherwise(0).alias("y"))
    for n in (*range(0, 34), 48, 100, 199, 250, 299, 300, 301):
        got = {r["y"]: r["count"] for r in sa.sample_n(few, n, ["row_id"], by="y", ranked_rows=1).groupBy("y").count().collect()}
        assert got == {y: k for y, k in ((0, min(n, 300)), (1, min(n, 30))) if k}, n


def test_refined_route_with_full_buckets(spark):
    two = spark.range(40_000).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("y"))
    for n in (48, 982, 4900, 4901):
        counts = sa.sample_n(two, n, ["row_id"], by="y", ranked_rows=1).groupBy("y").count().collect()
        assert [r["count"] for r in counts] == [n, n]
