"""The stream must close the flows the batch operator closes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowsieve import fixtures as fx
from flowsieve.operators import flows as fl
from flowsieve.plans.model_catalog import SLICE_FILES, _packet_slices, _run_to_table
from flowsieve.schema import PACKET_SCHEMA
from flowsieve.session import scratch_path
from flowsieve.sources import read_packets
from flowsieve.sources.packets import write_packets
from flowsieve.streaming.flows import alert_stream, current_threshold, flow_stream, set_threshold


def test_batch_equals_stream(spark, sf):
    stream = read_packets(spark, _packet_slices(spark, sf, 3), streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    live = _run_to_table(spark, flow_stream(stream))
    batch = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf)), endpoints=True).select(*live.columns)
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


def packets_at(spark, seconds, first_id=0):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return spark.createDataFrame([(first_id + i, start + dt.timedelta(seconds=s), True, 6, "1.1.1.1", "2.2.2.2", 5, 6, 100)
                                  for i, s in enumerate(seconds)], PACKET_SCHEMA)


@pytest.mark.parametrize("idle,flows", [(None, 1), ("60 seconds", 0)])
def test_idle_keys(spark, idle, flows):
    """Six packets, a long silence in which another key moves time on, then four more."""
    path = scratch_path(spark, "idle")
    write_packets(packets_at(spark, range(6)), path)
    other = packets_at(spark, [4000], 50).withColumn("src_ip", F.lit("7.7.7.7"))
    write_packets(other, path)
    write_packets(other.withColumn("packet_id", F.lit(51)), path)
    write_packets(packets_at(spark, range(4001, 4005), 100), path)
    stream = read_packets(spark, path, streaming=True, maxFilesPerTrigger="1")
    assert _run_to_table(spark, flow_stream(stream, idle=idle, watermark="1 second")).count() == flows


def test_threshold_is_read_per_batch(spark, sf):
    base = scratch_path(spark, "alerts")
    assert current_threshold(spark, f"{base}/t") == 0.5
    set_threshold(spark, f"{base}/t", 0.2)
    set_threshold(spark, f"{base}/t", 0.9)
    assert current_threshold(spark, f"{base}/t") == 0.9

    packets = _packet_slices(spark, sf, 2)
    seen = []

    def score(flows):
        seen.append(1)
        set_threshold(spark, f"{base}/t", 0.0)           # changed while the first batch is handled
        return flows.withColumn("proba", F.lit(0.5))

    stream = read_packets(spark, packets, streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    alert_stream(flow_stream(stream), score, f"{base}/t", f"{base}/out", f"{base}/bad", f"{base}/s", availableNow=True).awaitTermination()
    found = spark.read.parquet(f"{base}/out")
    assert len(seen) >= 2 and {r["threshold"] for r in found.select("threshold").distinct().collect()} == {0.0}


def keyed_rows(flows):
    return sorted(tuple(r) for r in flows.select("ip_a", "ip_b", "port_a", "win", "flow_duration", "fwd_packets", "flow_iat_max").collect())


def test_carried_batches_close_the_flows_of_one_table(spark, sf):
    """Batches of any size, keys silent in some of them, and a batch run twice."""
    from flowsieve.streaming.flows import flow_batch
    packets = fx.packets(spark, sf).persist()
    lo, hi = packets.agg(F.min("packet_id"), F.max("packet_id")).first()
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = [r[0] for r in packets.select(us.alias("us")).orderBy("us").collect()]
    edges = [cuts[0], cuts[len(cuts) // 7], cuts[len(cuts) // 2], cuts[len(cuts) // 2 + 5], cuts[-1] + 1]
    base = scratch_path(spark, "carried")
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        part = packets.where((us >= a) & (us < b))
        flow_batch(part, i, f"{base}/flows", f"{base}/waiting")
        if i == 2:                        # the batch fails after writing and is replayed
            first = keyed_rows(spark.read.parquet(f"{base}/flows"))
            flow_batch(part, i, f"{base}/flows", f"{base}/waiting")
            assert keyed_rows(spark.read.parquet(f"{base}/flows")) == first
    batch = fl.flow_features(fl.keyed_packets(packets), endpoints=True)
    assert keyed_rows(spark.read.parquet(f"{base}/flows")) == keyed_rows(batch) and hi > lo
    waiting = spark.read.parquet(f"{base}/waiting/batch=3").groupBy("ip_a", "ip_b", "port_a", "port_b", "proto").agg(F.count("packet_id").alias("n"), F.max("closed").alias("closed"))
    assert waiting.where("n > 9").isEmpty()
    whole = fl.keyed_packets(packets).groupBy("ip_a", "ip_b", "port_a", "port_b", "proto").count()
    assert whole.join(waiting, ["ip_a", "ip_b", "port_a", "port_b", "proto"]).where("count <> 10 * closed + n").isEmpty() and waiting.count() == whole.count()


def test_a_lost_version_is_an_error(spark, sf):
    from flowsieve.streaming.flows import flow_batch
    with pytest.raises(RuntimeError, match="no version 4"):
        flow_batch(fx.packets(spark, sf), 5, scratch_path(spark, "f"), scratch_path(spark, "c"))


def test_a_replay_uses_the_threshold_of_its_first_run(spark):
    from flowsieve.streaming.flows import threshold_of_batch
    path = scratch_path(spark, "threshold") + "/t"
    set_threshold(spark, path, 0.3)
    assert threshold_of_batch(spark, path, 0) == 0.3
    set_threshold(spark, path, 0.8)
    assert threshold_of_batch(spark, path, 0) == 0.3 and threshold_of_batch(spark, path, 1) == 0.8


def test_windows_start_again_after_a_gap_however_batches_fall(spark):
    """Ten packets, a gap, ten packets: window 0 twice, in one batch or in two."""
    for files in (1, 2):
        path = scratch_path(spark, "gap")
        one, two = packets_at(spark, range(10)), packets_at(spark, range(500, 510), 50)
        for part in ([one.union(two).coalesce(1)] if files == 1 else [one.coalesce(1), two.coalesce(1)]):
            write_packets(part, path)
        stream = read_packets(spark, path, streaming=True, maxFilesPerTrigger="1")
        assert [r["win"] for r in _run_to_table(spark, flow_stream(stream, idle="60 seconds", watermark="1 hour")).collect()] == [0, 0]


def test_keys_of_a_group_are_folded_together(spark, sf):
    """Few states for many keys, one of them without protocol; silent keys leave the state when the watermark has passed them."""
    from flowsieve.streaming.flows import _evicted, fold_keys
    packets = fx.packets(spark, sf).withColumn("proto", F.when(F.col("proto") != 17, F.col("proto")))
    path = scratch_path(spark, "grouped")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    half = packets.agg(F.percentile_approx(us, 0.5)).first()[0]
    for part in (us <= half, us > half):
        write_packets(packets.where(part).coalesce(1), path)
    out = scratch_path(spark, "grouped-out")
    running = (flow_stream(read_packets(spark, path, streaming=True, maxFilesPerTrigger="1"), groups=4).writeStream.format("parquet").option("path", out)
               .option("checkpointLocation", scratch_path(spark, "grouped-state")).trigger(availableNow=True).start())
    running.awaitTermination()
    assert running.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    live, batch = spark.read.parquet(out), fl.flow_features(fl.keyed_packets(packets), endpoints=True)
    batch = batch.select(*live.columns)
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty() and not batch.where("proto IS NULL").isEmpty()

    fresh = fl.keyed_packets(packets_at(spark, [0, 1, 2]).union(packets_at(spark, [500], 9).withColumn("src_port", F.lit(8)))).toPandas()
    nothing = ([],) * 11
    _, waiting, _ = fold_keys(nothing, fresh, 10, 60_000_000)
    flows, waiting, seen = fold_keys(waiting, fresh[fresh["port_a"] == 8].assign(us=lambda x: x["us"] + 1), 10, 60_000_000)
    assert len(flows) == 0 and list(seen) == [p == 8 for p in waiting[2]] and sorted(waiting[7]) == [2, 3]
    kept = _evicted(waiting, seen)
    assert list(kept[2]) == [8] and list(kept[7]) == [2] and len(kept[8]) == 2
