"""The command line jobs end to end on CSV files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowsieve import fixtures as fx
from flowsieve import jobs
from flowsieve.models import registry
from flowsieve.plans import training as tr
from flowsieve.sources.flows import write_flows_csv
from flowsieve.sources.packets import write_packets
from flowsieve.streaming.flows import current_threshold


def test_jobs_on_csv(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "CODES", ["nb", "dt", "ada", "et"])
    data, models, out = (str(tmp_path / n) for n in ("data", "models", "out"))
    write_flows_csv(fx.flows(spark, sf).drop("row_id", "copy"), data)
    run = jobs.train(spark, data, models, out)
    assert run.rows.count() == run.rows.select("row_id").distinct().count()
    comparison = spark.read.parquet(f"{out}/comparison")
    assert {r["model"] for r in comparison.collect()} == {"nb", "dt", "ada", "et", "iforest"}
    assert spark.read.parquet(f"{out}/report").count() == 25
    assert [tuple(r) for r in spark.read.parquet(f"{out}/status").select("available", "reason").distinct().collect()] == [(True, None)]

    jobs.cross_eval(spark, data, models, out, 0.5, 0.5)
    cross = spark.read.parquet(f"{out}/cross_dataset").collect()
    assert len(cross) == 7 and all(r["accuracy"] > 90 for r in cross)

    jobs.evaluate(spark, data, models, out)
    assert spark.read.parquet(f"{out}/external").count() == 4 and spark.read.parquet(f"{out}/report").count() == 20
    files = spark.read.parquet(f"{out}/external_files")
    assert files.count() == 4 * files.select("source_file").distinct().count() == spark.read.parquet(f"{out}/report_files").count() / 5
    assert files.agg(F.sum("total")).first()[0] == spark.read.parquet(f"{out}/external").agg(F.sum("total")).first()[0]

    jobs.simulate(spark, data, models, f"{out}/simulate")
    assert spark.read.parquet(f"{out}/simulate/sweep").count() == 100

    packets = str(tmp_path / "packets")
    write_packets(fx.packets(spark, sf), packets)
    jobs.live(spark, packets, models, f"{out}/live", availableNow=True).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{out}/live/alerts").columns[:2] == ["src_ip", "src_port"]

    jobs.threshold(spark, f"{out}/one", 0.25)
    assert current_threshold(spark, f"{out}/one/threshold") == 0.25
    jobs.live(spark, packets, models, f"{out}/one", model="nb", availableNow=True).awaitTermination()
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{out}/one/alerts").where("proba < 0.25").isEmpty()


def test_a_failing_model_gets_a_status_row(spark, sf, run, monkeypatch):
    fit = registry.fit
    monkeypatch.setattr(registry, "fit", lambda code, *a: fit(code, *a) if code == "nb" else 1 / 0)
    fresh = type(run)(run.rows)
    status = {r["model"]: (r["available"], r["reason"]) for r in tr.model_status(fresh, ["nb", "svm"]).collect()}
    assert status["nb"] == (True, None) and not status["svm"][0] and "ZeroDivisionError" in status["svm"][1]


def test_the_training_job_goes_on_and_says_which_model_failed(spark, sf, tmp_path, monkeypatch):
    fit = registry.fit
    monkeypatch.setattr(registry, "CODES", ["nb", "svm"])
    monkeypatch.setattr(registry, "fit", lambda code, *a: fit(code, *a) if code == "nb" else 1 / 0)
    data, models, out = (str(tmp_path / n) for n in ("data", "models", "out"))
    write_flows_csv(fx.flows(spark, sf).drop("row_id", "copy").limit(2000), data)
    jobs.train(spark, data, models, out)
    assert {r["model"] for r in spark.read.parquet(f"{out}/comparison").collect()} == {"nb", "iforest"}
    status = {r["model"]: r["reason"] for r in spark.read.parquet(f"{out}/status").collect()}
    assert status["nb"] is None and status["iforest"] is None and "ZeroDivisionError" in status["svm"]


def test_no_data_is_an_error_and_mock_is_asked_for(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        jobs.train(spark, str(tmp_path / "empty"), str(tmp_path / "m"), str(tmp_path / "o"))
