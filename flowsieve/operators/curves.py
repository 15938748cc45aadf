"""ROC, precision-recall and threshold curves.

Scores are counted per distinct value first (combined before the shuffle). Running totals over those counts
are one window per group while the counts are few; beyond ``SINGLE_TASK_ROWS`` they are range-partitioned by
score, written once so that the partition numbers are fixed, summed inside each partition and shifted by the
totals of the partitions before it. No task then sees more than its own range, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import percent, rate
from ..session import attach, materialize
from .scaling import spaced

SINGLE_TASK_ROWS = 2_000_000


def score_counts(df: DataFrame, by: list[str] = (), score: str = "proba") -> DataFrame:
    """Attack and benign rows per distinct score."""
    return df.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))


def written_counts(counts: DataFrame, by: list[str] = ()) -> DataFrame:
    """Counts by score, range partitioned and written once with the number of their partition."""
    return materialize(counts.repartitionByRange(*by, F.desc("threshold")).withColumn("part", F.spark_partition_id()), "scores")


def running_counts(kept: DataFrame, by: list[str] = (), single_task_rows: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Add tp and fp to `written_counts`: rows at or above each threshold, with the group totals n_pos and n_neg."""
    groups = list(by)
    totals = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    if kept.count() <= single_task_rows:
        upto = totals.orderBy(F.desc("threshold"))
        return kept.drop("part").withColumns({
            "tp": F.sum("pos").over(upto), "fp": F.sum("neg").over(upto),
            "n_pos": F.sum("pos").over(totals), "n_neg": F.sum("neg").over(totals)})
    # One row per partition and group: as few as the cluster has shuffle partitions.
    earlier = totals.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy(*groups, "part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).select(
        *groups, "part",
        F.coalesce(F.sum("pos").over(earlier), F.lit(0)).alias("tp_before"),
        F.coalesce(F.sum("neg").over(earlier), F.lit(0)).alias("fp_before"),
        F.sum("pos").over(totals).alias("n_pos"), F.sum("neg").over(totals).alias("n_neg"))
    upto = Window.partitionBy(*groups, "part").orderBy(F.desc("threshold"))
    return (attach(kept, starts, [*groups, "part"], "inner")
            .withColumn("tp", F.sum("pos").over(upto) + F.col("tp_before"))
            .withColumn("fp", F.sum("neg").over(upto) + F.col("fp_before"))
            .drop("part", "tp_before", "fp_before"))


def _end_point(kept: DataFrame, by: list[str], **values: float) -> DataFrame:
    """The one point per group that belongs to no score, from the written counts."""
    return kept.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold"),
                                    *[F.lit(v).alias(name) for name, v in values.items()])


def roc_curve(df: DataFrame, by: list[str] = (), score: str = "proba", **limits) -> DataFrame:
    """(fpr, tpr) at each distinct score, plus the (0, 0) start, whose threshold is null."""
    kept = written_counts(score_counts(df, by, score), by)
    running = running_counts(kept, by, **limits)
    points = running.select(
        *by, "threshold", rate(F.col("fp"), F.col("n_neg")).alias("fpr"), rate(F.col("tp"), F.col("n_pos")).alias("tpr"))
    return points.unionByName(_end_point(kept, by, fpr=0.0, tpr=0.0))


def roc_auc(df: DataFrame, by: list[str] = (), score: str = "proba", **limits) -> DataFrame:
    """Area under the ROC curve by trapezoids; null when a class is absent.

    Each score adds a trapezoid of width neg and heights tp - pos and tp, so no neighbour row is needed.
    """
    points = running_counts(written_counts(score_counts(df, by, score), by), by, **limits)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    whole = F.max("n_pos").cast("double") * F.max("n_neg")
    return points.groupBy(*by).agg(F.when(whole > 0, area / whole).alias("auc"))


def pr_curve(df: DataFrame, by: list[str] = (), score: str = "proba", **limits) -> DataFrame:
    """(recall, precision) at each distinct score, plus the (0, 1) end point, whose threshold is null."""
    kept = written_counts(score_counts(df, by, score), by)
    running = running_counts(kept, by, **limits)
    points = running.select(
        *by, "threshold", rate(F.col("tp"), F.col("n_pos"), 1.0).alias("recall"),
        rate(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))
    return points.unionByName(_end_point(kept, by, recall=0.0, precision=1.0))


def threshold_sweep(df: DataFrame, n: int = 100, by: list[str] = (), score: str = "proba") -> DataFrame:
    """Recall and TNR in percent at n thresholds from 0 to 1, calling a row attack at proba >= threshold.

    A row counts at every threshold up to its score, so rows are counted once by the highest threshold they
    reach (at most n + 1 counts per group), and each threshold then sums the counts at or above it.
    """
    at = lambda i: spaced(F.lit(0.0), F.lit(1.0), i, n)
    guess = F.greatest(F.lit(-1), F.least(F.lit(n - 1), F.floor(F.col(score) * (n - 1)).cast("int")))
    # The estimate can be off by one where score * (n - 1) rounds; compare with the thresholds themselves.
    reached = (F.when((guess + 1 < n) & (F.col(score) >= at(guess + 1)), guess + 1)
               .when((guess < 0) | (F.col(score) >= at(guess)), guess).otherwise(guess - 1))
    counts = df.groupBy(*by, reached.alias("reached")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    groups = counts.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.collect_list(F.struct("reached", "pos", "neg")).alias("c"))
    above = lambda what: F.aggregate(
        "c", F.lit(0).cast("long"),
        lambda acc, x: acc + F.when(x["reached"] >= F.col("i"), x[what]).otherwise(F.lit(0)))
    rows = groups.select(*by, "n_pos", "n_neg", "c", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    tp, fp = above("pos"), above("neg")
    return rows.select(*by, "i", at(F.col("i")).alias("threshold"), percent(tp, F.col("n_pos")).alias("recall"),
                       percent(F.col("n_neg") - fp, F.col("n_neg")).alias("tnr"))
