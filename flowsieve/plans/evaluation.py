"""Evaluation jobs over fitted models: external tables, one source in depth, all sources side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import registry
from ..operators import cascade as ca
from ..operators import cleaning as cl
from ..operators import curves as cu
from ..operators import metrics as me
from ..operators import sampling as sa
from ..operators import scaling as sc
from ..schema import ALERT_THRESHOLD, SEED
from ..session import materialize
from .training import TrainingRun, available, score_all

LAYERS = ("ada", "et")


def evaluate_external(run: TrainingRun, flows: DataFrame, codes: list[str] | None = None, by: list[str] = ()) -> DataFrame:
    """Any flow table scored with every model at hand: quality per model if it is labelled, else the prediction mix.

    ``by`` names columns of the table, such as ``source_file``, whose groups are judged by themselves in the same pass.
    """
    label, by = cl.find_label(flows), list(by)
    tagged = cl.with_target(flows) if label else flows
    models = available(run, codes or registry.CODES)
    wide = score_all(run.transform(tagged, keep=("y", *by)), models)
    counts = me.class_counts(wide, list(models), [*by, "y"] if label else by)
    return me.with_mix(me.compare_models(counts, by, "rows")) if label else me.prediction_mix(counts, [*by, "model"], "rows")


def external_reports(run: TrainingRun, flows: DataFrame, codes: list[str] | None = None, by: list[str] = ()) -> DataFrame:
    """Classification report of each model at hand on a labelled flow table, for all of it or for each group ``by``."""
    models, by = available(run, codes or registry.CODES), list(by)
    wide = score_all(run.transform(cl.with_target(flows), keep=("y", *by)), models)
    return me.classification_report(me.confusion(me.class_counts(wide, list(models), [*by, "y"]), [*by, "model"], "rows"))


def cascade_scores(run: TrainingRun, scaled: DataFrame, layers: tuple[str, str] = LAYERS, anomaly: bool = True) -> DataFrame:
    """Layer scores, cascade class, combined probability and verdict for every row.

    Without an anomaly model in the run's saved set the verdict is the supervised cascade.
    """
    first, second = (run.model(code) for code in layers)
    scored = first.score(scaled).withColumnsRenamed({"proba": "p1", "pred": "pred1"})
    scored = second.score(scored).withColumnsRenamed({"proba": "p2", "pred": "pred2"})
    found = available(run, [registry.ANOMALY]) if anomaly else {}
    if found:
        scored = found[registry.ANOMALY].score(scored).withColumnRenamed("pred", "anomaly").drop("proba")
    scored = ca.cascade_proba(ca.cascade_predict(scored))
    return ca.cascade_detailed(scored, "anomaly" if found else None)


def score_flow_windows(run: TrainingRun, flows: DataFrame, layers: tuple[str, str] = LAYERS) -> DataFrame:
    """Assembled flows, batch or micro-batch, with the cascade's combined probability; their own columns stay raw."""
    scaled = run.transform(flows.withColumn("_flow", F.struct(*flows.columns)), keep=("_flow",))
    return cascade_scores(run, scaled, layers, anomaly=False).select("_flow.*", "proba")


def score_with_model(run: TrainingRun, flows: DataFrame, code: str) -> DataFrame:
    """Assembled flows with the probability of one model; their own columns stay raw."""
    scaled = run.transform(flows.withColumn("_flow", F.struct(*flows.columns)), keep=("_flow",))
    return run.model(code).score(scaled).select("_flow.*", "proba")


def cross_source_report(run: TrainingRun, flows: DataFrame, key: list[str], cap: int | None = None, t1: float = ALERT_THRESHOLD,
                        t2: float = ALERT_THRESHOLD, layers: tuple[str, str] = LAYERS, seed: int = SEED) -> DataFrame:
    """The cascade at two thresholds on every row of every source: one scored table, one aggregation.

    ``cap`` (such as `schema.CROSS_EVAL_CAP`) judges on at most so many rows of each source instead.
    """
    clean = cl.drop_non_finite(cl.clean_columns(flows))
    sampled = cl.with_target(clean if cap is None else sa.sample_n(clean, cap, key, by="source_file", seed=f"{seed}:cross"))
    scored = cascade_scores(run, run.transform(sampled, keep=("source_file", "y")), layers, anomaly=False)
    return me.cross_dataset_eval(ca.cascade_threshold(scored, t1, t2))


def single_source(run: TrainingRun, flows: DataFrame, key: list[str], cap: int | None = None, seed: int = SEED) -> DataFrame:
    """The clean rows of one source, raw, with row id and target; the input of the two reports below, which write it if they read it often.

    ``cap`` (such as `schema.SINGLE_EVAL_CAP`) keeps at most so many rows instead of all.
    """
    clean = cl.drop_non_finite(cl.clean_columns(flows))
    sampled = cl.with_target(clean if cap is None else sa.sample_n(clean, cap, key, seed=f"{seed}:single"))
    return cl.conform(sampled, keep=("row_id", "y"))


AVAILABILITY = ("quality", "roc", "auc", "pr", "sweep", "grid", "points")
CASCADE = ("quality", "report", "roc", "auc", "pr", "sweep")


def _known_parts(parts: tuple[str, ...], offered: tuple[str, ...]) -> None:
    unknown = [part for part in parts if part not in offered]
    if unknown or not parts:
        raise ValueError(f"a report has the parts {offered}, not {unknown or 'none'}")


def _curves(scored: DataFrame, parts: tuple[str, ...], by: list[str] = ()) -> dict[str, DataFrame]:
    """Those of the curves that are wanted."""
    made = {"roc": cu.roc_curve, "auc": cu.roc_auc, "pr": cu.pr_curve, "sweep": cu.threshold_sweep}
    return {part: make(scored, by=by) for part, make in made.items() if part in parts}


def availability_report(run: TrainingRun, raw: DataFrame, codes: list[str] | None = None, parts: tuple[str, ...] = AVAILABILITY) -> dict[str, DataFrame]:
    """Every model on one source: quality table, ROC and PR points, AUC, threshold sweep, decision grid, sample points.

    Only the ``parts`` named are made; rows and scores are written when more than one part reads them. A model that the run
    holds and that fails, or a part that does not exist, is an error.
    """
    _known_parts(parts, AVAILABILITY)
    raw = materialize(raw, "single-source") if len(parts) > 1 else raw
    made, judged = {}, [part for part in parts if part not in ("grid", "points")]
    if judged:
        models = available(run, codes or registry.CODES)
        wide = score_all(run.transform(raw, keep=("row_id", "y")), models)
        wide = wide.select("y", *[f"{tag}_{code}" for code in models for tag in ("p", "pred")])
        wide = materialize(wide, "scores") if len(judged) > 1 else wide
        made = {"quality": me.compare_models(me.class_counts(wide, list(models)), rows="rows")} if "quality" in parts else {}
        made |= _curves(me.long_scores(wide, list(models), ["y"]), parts, ["model"])
    if "grid" in parts:
        made["grid"] = decision_grid(run, raw, codes)
    if "points" in parts:
        made["points"] = sa.class_sample(raw)
    return made


def cascade_report(run: TrainingRun, raw: DataFrame, layers: tuple[str, str] = LAYERS, parts: tuple[str, ...] = CASCADE) -> dict[str, DataFrame]:
    """The cascade on one source: quality, report, curves and sweep of the combined probability; only the ``parts`` named are made."""
    _known_parts(parts, CASCADE)
    scored = cascade_scores(run, run.transform(raw, keep=("row_id", "y")), layers, anomaly=False).select("y", "pred", "proba")
    scored = materialize(scored, "cascade-scores") if len(parts) > 1 else scored
    cm = me.confusion(scored)
    made = {"quality": me.with_bayes(me.rates(cm)), "report": me.classification_report(cm)}
    return {part: table for part, table in made.items() if part in parts} | _curves(scored, parts)


def decision_grid(run: TrainingRun, raw: DataFrame, codes: list[str] | None = None, res: int = 40) -> DataFrame:
    """Each model's class on the grid over two features: (cell, ix, iy, x, y, model, pred).

    Grid values are in raw units; only the copy the models see is scaled.
    """
    grid = sc.feature_grid(raw, res=res)
    models = available(run, codes or registry.CODES)
    marked = grid.withColumns({"x": F.col("flow_duration"), "y": F.col("fwd_len_max")})
    keep = ("cell", "ix", "iy", "x", "y")
    wide = score_all(run.transform(marked, keep=keep), models)
    return me.long_scores(wide, list(models), list(keep)).drop("proba")
