"""Window closing, numbering across ranges and the first inter-arrival value."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowsieve import fixtures as fx
from flowsieve.operators import alerts as al
from flowsieve.operators import flows as fl
from flowsieve.schema import FLOW_KEY, PACKET_SCHEMA


def packets(spark, times, src="1.1.1.1", dst="2.2.2.2", proto=6, lengths=None):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(i, start + dt.timedelta(microseconds=t), True, proto, src, dst, 1000, 80, (lengths or [100] * len(times))[i])
            for i, t in enumerate(times)]
    return spark.createDataFrame(rows, PACKET_SCHEMA)


@pytest.mark.parametrize("n,closed", [(9, 0), (10, 1), (11, 1), (20, 2)])
def test_windows_of_ten(spark, n, closed):
    keyed = fl.keyed_packets(packets(spark, list(range(n))))
    assert fl.flow_features(keyed).count() == closed
    assert fl.count_windows(keyed).count() == closed * 10
    assert fl.flow_features(keyed, parts=5).count() == closed


def test_one_instant(spark):
    row = fl.flow_features(fl.keyed_packets(packets(spark, [7] * 10))).first()
    assert (row["flow_duration"], row["flow_bytes_s"], row["flow_packets_s"], row["flow_iat_max"]) == (0, 0.0, 0.0, 0)


def test_features_by_hand(spark):
    times = [0, 10, 20, 30, 40, 50, 60, 70, 80, 1000]
    row = fl.flow_features(fl.keyed_packets(packets(spark, times, lengths=list(range(1, 11)))), endpoints=True).first()
    assert row["flow_duration"] == 1000 and row["flow_iat_max"] == 920 and row["flow_iat_mean"] == 100.0
    assert (row["fwd_packets"], row["bwd_packets"]) == (10, 0)
    assert (row["fwd_len_total"], row["fwd_len_max"], row["fwd_len_min"], row["fwd_len_mean"]) == (55, 10, 1, 5.5)
    assert (row["bwd_len_total"], row["bwd_len_max"], row["bwd_len_min"], row["bwd_len_mean"]) == (0, 0, 0, 0.0)
    assert row["flow_bytes_s"] == pytest.approx(55_000.0) and row["flow_packets_s"] == pytest.approx(10_000.0)
    assert (row["src_ip"], row["src_port"], row["dst_ip"], row["dst_port"]) == ("1.1.1.1", 1000, "2.2.2.2", 80)


def test_key_direction(spark):
    there = fl.keyed_packets(packets(spark, [0], "9.9.9.9", "10.0.0.1")).first()
    assert (there["ip_a"], there["port_a"], there["fwd"]) == ("10.0.0.1", 80, 0)      # text order, not numeric
    same = fl.keyed_packets(packets(spark, [0], "5.5.5.5", "5.5.5.5")).first()
    assert (same["port_a"], same["port_b"], same["fwd"]) == (80, 1000, 0)
    icmp = fl.keyed_packets(packets(spark, [0], proto=1)).first()
    assert (icmp["port_a"], icmp["port_b"]) == (0, 0)


def by_windows(keyed, size=10):
    """The plain way: one window per key."""
    by_time = Window.partitionBy(*FLOW_KEY).orderBy("us", "packet_id")
    return (keyed.withColumn("ord", (F.row_number().over(by_time) - 1).cast("long")).withColumn("prev", F.lag("us").over(by_time))
            .withColumn("n", F.count("*").over(Window.partitionBy(*FLOW_KEY)))
            .withColumn("win", F.floor(F.col("ord") / size)).where((F.col("win") + 1) * size <= F.col("n"))
            .withColumn("iat", F.when(F.col("ord") % size == 0, F.lit(0)).otherwise(F.col("us") - F.col("prev"))).drop("prev", "n"))


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_ranges_equal_plain_windows(spark, sf, parts):
    keyed = fl.keyed_packets(fx.packets(spark, sf))
    plain = by_windows(keyed)
    ranged = fl.count_windows(keyed, parts=parts).select(*plain.columns)
    assert plain.exceptAll(ranged).isEmpty() and ranged.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("size", [1, 2, 10])
def test_one_key_over_many_ranges(spark, size):
    """A key without protocol, one whose packets share an instant, and one that lives long with one full second."""
    at = lambda n, us, proto, ip: packets(spark, [us(i) for i in range(n)], ip, "2.2.2.2", proto=proto)
    table = (at(60, lambda i: 7 * i, None, "1.1.1.1").unionByName(at(95, lambda i: 5, 6, "1.1.1.2"))
             .unionByName(at(90, lambda i: i * 3_600_000_000 if i < 30 else 29 * 3_600_000_000 + i, 17, "1.1.1.3")))
    keyed = fl.keyed_packets(table.withColumn("packet_id", F.xxhash64("packet_id", "src_ip")))
    plain = by_windows(keyed, size)
    assert plain.count() == (60 + 90 + 90 if size == 10 else 245 - (size == 2))
    for parts in (1, 3, 40):            # 40: ranges of a few packets, so a window lies across several
        ranged = fl.count_windows(keyed, size, parts=parts).select(*plain.columns)
        assert plain.exceptAll(ranged).isEmpty() and ranged.exceptAll(plain).isEmpty()


def test_batches_of_a_range_are_one_sequence():
    """Numbering does not depend on where a task's batches are cut."""
    keys = [("a", "b", 1, 2, None)] * 23 + [("a", "b", 1, 2, 6)] * 9 + [("a", "c", 1, 2, 6)] + [("b", "c", 1, 2, 6)] * 40
    rows = pa.table([*map(pa.array, zip(*keys, strict=True)), pa.array(range(len(keys)), pa.int64())], names=[*FLOW_KEY, "us"])
    whole = pa.Table.from_batches(fl.number_in_range(iter(rows.to_batches()), 3, 9))
    assert whole["ord"].to_pylist() == [*range(23), *range(9), 0, *range(40)]
    assert whole["left"].to_pylist() == [min(9, n - 1 - i) for n in (23, 9, 1, 40) for i in range(n)]
    assert [x for x in whole["prev_us"].to_pylist() if x is None] == [None] * 4
    for cut in (1, 2, 5, 10, 50):
        assert pa.Table.from_batches(fl.number_in_range(iter(rows.to_batches(cut)), 3, 9)).equals(whole)


def test_empty_packets(spark):
    keyed = fl.keyed_packets(packets(spark, []))
    assert fl.count_windows(keyed).isEmpty() and fl.flow_features(keyed, endpoints=True).isEmpty()


def test_packets_are_shuffled_once(spark, sf):
    """After the ranges are written only window sums move: one exchange, behind the partial aggregate."""
    plan = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan.split("Exchange hashpartitioning")[1]
    assert " Window" not in plan


def test_alerts_keep_rejected_flows(spark, sf):
    flows = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf)), endpoints=True)
    broken = flows.withColumn("flow_bytes_s", F.when(F.col("win") == 0, float("nan")).otherwise(F.col("flow_bytes_s")))
    scored, rejected = al.score_flows(broken, lambda d: d.withColumn("proba", F.lit(0.5)))
    assert scored.count() + rejected.count() == flows.count() and rejected.count() > 0
    assert al.alerts(scored).count() == scored.count()
    assert al.alerts(scored, 0.51).count() == 0
