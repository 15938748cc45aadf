"""Detection quality as DataFrames. Every metric is one pass with grouped counts, no loop over models or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attack_family, percent, rate
from ..schema import BASE_RATES


def _count(where: Column, rows: str | None) -> Column:
    """Rows where it holds; ``rows`` names a column that says how many rows a row stands for."""
    return F.count_if(where) if rows is None else F.coalesce(F.sum(F.when(where, F.col(rows))), F.lit(0))


def confusion(df: DataFrame, by: list[str] = (), rows: str | None = None) -> DataFrame:
    """tn, fp, fn, tp from columns ``y`` and ``pred``; always four counts, also when a class is absent."""
    cell = lambda y, pred: _count((F.col("y") == y) & (F.col("pred") == pred), rows)
    return df.groupBy(*by).agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def rates(cm: DataFrame, empty_tnr: float = 0.0) -> DataFrame:
    """Add recall, tnr, fpr and accuracy in percent to confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return cm.withColumns({
        "recall": percent(tp, tp + fn), "tnr": percent(tn, tn + fp, empty_tnr), "fpr": percent(fp, tn + fp),
        "accuracy": percent(tp + tn, tn + fp + fn + tp)})


def _posterior(base_rate: Column) -> Column:
    hit = F.col("recall") / 100.0 * base_rate
    alarm = hit + F.col("fpr") / 100.0 * (1.0 - base_rate)
    return percent(hit, alarm)


def bayes_rate(rated: DataFrame, base_rates: list[float]) -> DataFrame:
    """P(attack | alert) in percent, one row per input row and base rate."""
    thetas = F.explode(F.array(*[F.lit(float(t)) for t in base_rates]))
    return rated.withColumn("theta", thetas).withColumn("bayes", _posterior(F.col("theta")))


def with_bayes(rated: DataFrame) -> DataFrame:
    """P(attack | alert) at the two standard base rates as columns."""
    return rated.withColumns({name: _posterior(F.lit(theta)) for name, theta in BASE_RATES.items()})


def classification_report(cm: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    keys = [c for c in cm.columns if c not in ("tn", "fp", "fn", "tp")]

    def scores(hit: Column, predicted: Column, support: Column) -> list[Column]:
        return [rate(hit, predicted), rate(hit, support), rate(2 * hit, predicted + support), support]

    benign, attack = scores(tn, tn + fn, tn + fp), scores(tp, tp + fp, tp + fn)
    total = tn + fp + fn + tp
    macro = [(b + a) / 2.0 for b, a in zip(benign[:3], attack[:3])] + [total]
    weighted = [rate(b * benign[3] + a * attack[3], total) for b, a in zip(benign[:3], attack[:3])] + [total]
    accuracy = [rate(tn + tp, total)] * 3 + [total]
    lines = [("Benign", benign), ("Attack", attack), ("accuracy", accuracy), ("macro avg", macro),
             ("weighted avg", weighted)]
    rows = F.array(*[
        F.struct(F.lit(name).alias("class"), *[v.alias(c) for v, c in
                                               zip(values, ("precision", "recall", "f1", "support"))])
        for name, values in lines])
    return cm.select(*keys, F.inline(rows))


def prediction_mix(df: DataFrame, by: list[str] = (), rows: str | None = None) -> DataFrame:
    """How many rows were called benign or attack, with the attack share; needs no label."""
    return df.groupBy(*by).agg(
        (F.count("*") if rows is None else F.coalesce(F.sum(rows), F.lit(0))).alias("total"),
        _count(F.col("pred") == 0, rows).alias("benign"), _count(F.col("pred") == 1, rows).alias("attack"),
    ).withColumn("attack_pct", percent(F.col("attack"), F.col("total")))


def with_mix(compared: DataFrame) -> DataFrame:
    """The mix of `prediction_mix` next to the rates: it follows from the same four counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    mixed = compared.withColumns({"total": tn + fp + fn + tp, "benign": tn + fn, "attack": fp + tp})
    return mixed.withColumn("attack_pct", percent(F.col("attack"), F.col("total")))


def long_scores(df: DataFrame, models: list[str], keep: list[str] = ("row_id", "y")) -> DataFrame:
    """Wide ``p_<model>`` / ``pred_<model>`` columns to one row per input row and model."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").cast("int").alias("pred"),
                              F.col(f"p_{m}").alias("proba")) for m in models])
    return df.select(*keep, F.inline(rows))


def class_counts(df: DataFrame, models: list[str], keep: list[str] = ("y",)) -> DataFrame:
    """Wide ``pred_<model>`` columns to (``keep``, model, pred, rows): how many rows each model called what.

    Rows are counted per combination of classes first, of which there are few, so no row is repeated for every model.
    """
    counts = df.groupBy(*keep, *[f"pred_{m}" for m in models]).agg(F.count("*").alias("rows"))
    calls = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").cast("int").alias("pred")) for m in models])
    return counts.select(*keep, "rows", F.inline(calls))


def compare_models(long: DataFrame, by: list[str] = (), rows: str | None = None) -> DataFrame:
    """Confusion counts, rates and Bayesian detection rates per model, and per further columns ``by``."""
    return with_bayes(rates(confusion(long, [*by, "model"], rows)))


def cross_dataset_eval(scored: DataFrame, by: str = "source_file") -> DataFrame:
    """Per source: attack family, rows per class, recall, TNR (100 without benign rows) and accuracy."""
    table = rates(confusion(scored, [by]), empty_tnr=100.0)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return table.select(by, attack_family(F.col(by)).alias("attack_type"), (tn + fp + fn + tp).alias("samples"),
                        (tn + fp).alias("benign"), (tp + fn).alias("attack"), "recall", "tnr", "accuracy")
