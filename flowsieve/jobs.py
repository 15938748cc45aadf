"""Command line jobs for spark-submit: train, evaluate, cross-eval, availability, simulate, live.

    python -m flowsieve.jobs train --data DIR --models DIR --out DIR

On a cluster set ``spark.checkpoint.dir`` to a folder all executors share.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from .models import registry
from .operators import cleaning as cl
from .plans import evaluation as ev
from .plans import training as tr
from .schema import ALERT_THRESHOLD
from .session import compile_small_methods, scratch_path, ship_package
from .sources import mock_flows, read_flows, read_packets, resolve_source, stage_flows, write_metrics
from .sources.flows import CROSS_EVAL_EXCLUDE, TRAIN_EXCLUDE
from .streaming.flows import alert_batch, alert_stream, flow_job, flow_stream, set_threshold

TAGS = ("row_id", "source_file")   # columns of a staged table that are no data


def staged(spark: SparkSession, path: str, exclude: list[str]) -> DataFrame:
    """CSV sources as a Parquet table with row ids; later passes prune columns and sources."""
    return stage_flows(read_flows(spark, path, exclude), scratch_path(spark, "staged"))


def write_all(tables: dict[str, DataFrame], out: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")


def train(spark: SparkSession, data: str, models: str, out: str, mock: bool = False) -> tr.TrainingRun:
    """Fit the ten classifiers and the anomaly model, save them, and write the comparison on held-out rows.

    A model that fails gets a line in the status table, and the others are compared and saved. Only ``mock`` trains on generated
    rows; a folder without flow files is an error otherwise.
    """
    if mock:
        path = resolve_source(spark, f"{data}/mock_flows.csv", f"{data}/mock_flows.csv", lambda: mock_flows(spark))
        flows = stage_flows(read_flows(spark, path), scratch_path(spark, "staged"))
    else:
        flows = staged(spark, data, TRAIN_EXCLUDE)
    run = tr.TrainingRun(tr.training_rows(flows, TAGS))
    write_all({"status": tr.model_status(run, [*registry.CODES, registry.ANOMALY])}, out)
    codes, anomaly = [code for code in registry.CODES if code in run.models], registry.ANOMALY in run.models
    write_all({"depth_study": tr.depth_study(run.train, run.test), "comparison": tr.compare_on_test(run, codes, anomaly),
               "report": tr.report_on_test(run, codes, anomaly)}, out)
    run.save(spark, models)
    return run


def evaluate(spark: SparkSession, data: str, models: str, out: str) -> None:
    """Score any flow CSV with every saved model, all files together and each file by itself."""
    flows = read_flows(spark, data)
    run = tr.SavedRun(spark, models)
    whole = flows.drop("source_file")
    tables = {"external": ev.evaluate_external(run, whole), "external_files": ev.evaluate_external(run, flows, by=["source_file"])}
    if cl.find_label(flows):
        tables |= {"report": ev.external_reports(run, whole), "report_files": ev.external_reports(run, flows, by=["source_file"])}
    write_all(tables, out)


def cross_eval(spark: SparkSession, data: str, models: str, out: str, t1: float, t2: float) -> None:
    """The cascade on every source side by side, written as a report with its thresholds."""
    flows = staged(spark, data, CROSS_EVAL_EXCLUDE)
    write_metrics(ev.cross_source_report(tr.SavedRun(spark, models), flows, ["row_id"], t1=t1, t2=t2), f"{out}/cross_dataset", t1, t2)


def one_source(spark: SparkSession, data: str) -> DataFrame:
    path = resolve_source(spark, data, f"{scratch_path(spark, 'mock')}/mock_flows.csv", lambda: mock_flows(spark))
    return stage_flows(read_flows(spark, path), scratch_path(spark, "staged"))


def availability(spark: SparkSession, data: str, models: str, out: str) -> None:
    """All saved models on one source: quality, curves, sweep, decision grid."""
    run = tr.SavedRun(spark, models)
    flows = one_source(spark, data)
    label = cl.find_label(flows)
    counts = {"labels": cl.label_counts(cl.drop_non_finite(cl.clean_columns(flows)), label)} if label else {}
    write_all({**ev.availability_report(run, ev.single_source(run, flows, ["row_id"])), **counts}, out)


def simulate(spark: SparkSession, data: str, models: str, out: str) -> None:
    """The cascade on one source: quality, report, curves, sweep."""
    run = tr.SavedRun(spark, models)
    write_all(ev.cascade_report(run, ev.single_source(run, one_source(spark, data), ["row_id"])), out)


def live(spark: SparkSession, data: str, models: str, out: str, idle: str | None = None, model: str | None = None,
         layers: tuple[str, str] = ev.LAYERS, **trigger):
    """Packet stream to alerts of the cascade, or of one model; the threshold table may change while it runs."""
    run = tr.SavedRun(spark, models)
    packets = read_packets(spark, data, streaming=True, maxFilesPerTrigger="100")
    def score(flows: DataFrame) -> DataFrame:
        return ev.score_with_model(run, flows, model) if model else ev.score_flow_windows(run, flows, layers)

    paths = (f"{out}/threshold", f"{out}/alerts", f"{out}/rejected")
    if idle:
        return alert_stream(flow_stream(packets, idle=idle), score, *paths, f"{out}/checkpoint", **trigger)
    return flow_job(packets, f"{out}/flows", f"{out}/waiting", f"{out}/checkpoint",
                    then=lambda flows, batch_id: alert_batch(flows, batch_id, score, *paths), **trigger)


def threshold(spark: SparkSession, out: str, value: float) -> None:
    """Set the threshold of the live job that writes to ``out``, from its next micro-batch on."""
    set_threshold(spark, f"{out}/threshold", value)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="flowsieve")
    parser.add_argument("job", choices=["train", "evaluate", "cross-eval", "availability", "simulate", "live", "threshold"])
    for name in ("data", "models", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--t1", type=float, default=ALERT_THRESHOLD)
    parser.add_argument("--t2", type=float, default=ALERT_THRESHOLD)
    parser.add_argument("--idle", default=None)
    parser.add_argument("--model", default=None, help="score live flows with one model")
    parser.add_argument("--layers", nargs=2, default=ev.LAYERS, help="layers of the live cascade")
    parser.add_argument("--threshold", type=float, default=ALERT_THRESHOLD)
    parser.add_argument("--mock", action="store_true", help="train on generated rows")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"flowsieve-{args.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship_package(spark)
    compile_small_methods(spark)
    paths = (spark, args.data, args.models, args.out)
    if args.job == "train":
        train(*paths, args.mock)
    elif args.job == "cross-eval":
        cross_eval(*paths, args.t1, args.t2)
    elif args.job == "live":
        live(*paths, args.idle, args.model, tuple(args.layers)).awaitTermination()
    elif args.job == "threshold":
        threshold(spark, args.out, args.threshold)
    else:
        {"evaluate": evaluate, "availability": availability, "simulate": simulate}[args.job](*paths)


if __name__ == "__main__":
    main()
