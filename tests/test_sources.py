"""CSV reading, fallbacks, persistence of parameters and generated flows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowsieve.schema import FEATURES
from flowsieve.session import scratch_path
from flowsieve.sources import (
    load_table, mock_flows, read_flows, resolve_source, save_table, stage_flows, write_metrics,
)
from flowsieve.sources.flows import CROSS_EVAL_EXCLUDE, TRAIN_EXCLUDE, header_names, write_flows_csv

HEADER = " Flow Duration, Total Fwd Packets,Fwd Header Length, Fwd Header Length, Label"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "Monday-x.csv").write_text(f"{HEADER}\n1,2,3,4,BENIGN\n")
    (tmp_path / "Friday DDos.csv").write_text(f"{HEADER}\n1e3,Infinity,3,4, PortScan\n-inf,NaN,,4,BENIGN\nx,5,3,4,\n")
    (tmp_path / "mock_flows.csv").write_text(f"{HEADER}\n9,9,9,9,BENIGN\n")
    (tmp_path / "notes.txt").write_text("a,b\n1,2\n")
    (tmp_path / "UPPER.CSV").write_text(f"{HEADER}\n9,9,9,9,BENIGN\n")
    return str(tmp_path)


def test_header_names():
    assert header_names(HEADER) == ["Flow Duration", "Total Fwd Packets", "Fwd Header Length", "Fwd Header Length.1", "Label"]


def test_exclusions_and_suffix(spark, folder):
    names = lambda ex: sorted(r[0] for r in read_flows(spark, folder, ex).select("source_file").distinct().collect())
    assert names([]) == ["Friday DDos.csv", "Monday-x.csv", "mock_flows.csv"]
    assert names(TRAIN_EXCLUDE) == ["Friday DDos.csv", "Monday-x.csv"]
    assert names(CROSS_EVAL_EXCLUDE) == ["Friday DDos.csv"]


def test_values(spark, folder):
    rows = read_flows(spark, folder, CROSS_EVAL_EXCLUDE).collect()
    assert [r["flow_duration"] for r in rows] == [1000.0, float("-inf"), None]
    assert [r["fwd_packets"] for r in rows] == [float("inf"), None, 5.0]
    assert [r["Label"] for r in rows] == [" PortScan", "BENIGN", None]
    assert [r["Fwd Header Length.1"] for r in rows] == ["4"] * 3


def test_mixed_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration,Label\n1,BENIGN\n")
    (tmp_path / "b.csv").write_text("Label, Flow Duration,Extra\nDDoS,2,7\n")
    rows = read_flows(spark, str(tmp_path)).orderBy("flow_duration").collect()
    assert [(r["flow_duration"], r["Label"], r["Extra"]) for r in rows] == [(1.0, "BENIGN", None), (2.0, "DDoS", "7")]


def test_columns_in_another_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration,Total Fwd Packets,Label\n1,2,BENIGN\n")
    (tmp_path / "b.csv").write_text("Total Fwd Packets,Flow Duration,Label\n2,1,BENIGN\n")
    rows = read_flows(spark, str(tmp_path)).select("flow_duration", "fwd_packets", "Label").collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.0, "BENIGN")] * 2


def test_row_ids_do_not_depend_on_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration,Label\n" + "".join(f"{i % 40},x\n" for i in range(100)))
    flows = read_flows(spark, str(tmp_path))
    ids = [sorted(r["row_id"] for r in stage_flows(flows.repartition(n), str(tmp_path / f"staged{n}")).collect()) for n in (2, 8)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 100


def test_nothing_to_read(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        read_flows(spark, str(tmp_path))


def test_resolve_source(spark, tmp_path):
    real, mock = str(tmp_path / "real.csv"), str(tmp_path / "mock.csv")
    calls = []

    def generate():
        calls.append(1)
        return mock_flows(spark, 50)

    assert resolve_source(spark, real, mock, generate) == mock
    assert resolve_source(spark, real, mock, generate) == mock and calls == [1]
    (tmp_path / "real.csv").write_text("Flow Duration\n1\n")
    assert resolve_source(spark, real, mock, generate) == real
    assert read_flows(spark, mock).count() == 50


def test_staged_rows_have_unique_ids(spark, folder):
    staged = stage_flows(read_flows(spark, folder), scratch_path(spark, "staged"))
    assert staged.count() == staged.select("row_id").distinct().count() == 5


def test_csv_round_trip(spark, tmp_path):
    flows = mock_flows(spark, 100).withColumn("source_file", F.lit("Tuesday.csv"))
    path = str(tmp_path / "out")
    write_flows_csv(flows, path)
    back = read_flows(spark, path)
    assert back.select(*FEATURES).exceptAll(flows.select(*FEATURES)).isEmpty() and back.count() == 100


def test_mock_moments(spark):
    flows = mock_flows(spark, 5000)
    stats = flows.agg(F.avg("flow_duration"), F.stddev("flow_duration"), F.corr("flow_duration", "fwd_packets"),
                      F.avg((F.col("label") == "BENIGN").cast("int"))).first()
    assert stats[0] == pytest.approx(100, rel=0.05) and stats[1] == pytest.approx(100, rel=0.08)
    assert abs(stats[2]) < 0.05 and stats[3] == pytest.approx(0.85, abs=0.02)
    assert flows.exceptAll(mock_flows(spark, 5000)).isEmpty()


def test_store(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_table(spark, str(tmp_path / "absent"))
    save_table(spark.range(3), str(tmp_path / "t"))
    assert load_table(spark, str(tmp_path / "t")).count() == 3


def test_metrics_as_csv(spark, tmp_path):
    table = spark.createDataFrame([("a.csv", 99.0)], "source_file STRING, recall DOUBLE")
    write_metrics(table, str(tmp_path / "m"), 0.4, 0.6, "csv")
    row = spark.read.option("header", True).csv(str(tmp_path / "m")).first()
    assert (row["recall"], row["threshold_1"], row["threshold_2"]) == ("99.0", "0.4", "0.6")
