"""Packets to flows: key, count windows, inter-arrival times, the 15 features.

Scale notes. Packets are shuffled once, into ranges of (key, time, packet id), and written in that order; a key of any size
is spread over as many ranges as its packets need, so no key is looked for or treated apart. Tasks number the packets of
the keys in their range, batch by batch; what a range starts with and ends in (one row per range) then says how many packets
of its first key lie before it and of its last key behind it. Ordinals, gaps and closed windows follow row by row,
and only the per-window aggregate is shuffled after its map-side part. Null key parts are parts like any other.

The first inter-arrival value of a window is 0 (its start is its first packet), and it still counts, so
the mean of n packets is duration / n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import guarded_rate
from ..schema import FLOW_KEY, FLOW_SIZE
from ..session import materialize

# Protocol numbers that carry ports (TCP, UDP).
PORT_PROTOCOLS = [6, 17]


def packet_normalize(packets: DataFrame) -> DataFrame:
    """IPv4 packets only; ports are kept for TCP and UDP and 0 for every other protocol."""
    ip = F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()
    if "is_ip" in packets.columns:
        ip = F.col("is_ip") & ip
    ports = F.col("proto").isin(PORT_PROTOCOLS)
    return packets.where(ip).select(
        "packet_id", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "proto", "src_ip", "dst_ip",
        F.coalesce(F.when(ports, F.col("src_port")), F.lit(0)).alias("src_port"),
        F.coalesce(F.when(ports, F.col("dst_port")), F.lit(0)).alias("dst_port"),
        "length")


def flow_key(normalized: DataFrame) -> DataFrame:
    """Both directions of a talk get one key; ``fwd`` marks packets sent by the smaller address.

    Addresses compare as text. Equal addresses always count as backward, with swapped ports.
    """
    fwd = F.col("src_ip") < F.col("dst_ip")
    pick = lambda a, b: F.when(fwd, F.col(a)).otherwise(F.col(b))
    return normalized.select(
        "*",
        fwd.cast("int").alias("fwd"),
        pick("src_ip", "dst_ip").alias("ip_a"), pick("dst_ip", "src_ip").alias("ip_b"),
        pick("src_port", "dst_port").alias("port_a"), pick("dst_port", "src_port").alias("port_b"))


def keyed_packets(packets: DataFrame) -> DataFrame:
    return flow_key(packet_normalize(packets))


def number_in_range(batches: Iterator[pa.RecordBatch], part: int, ahead: int) -> Iterator[pa.RecordBatch]:
    """Number the packets of sorted batches inside each key: place in the range, ordinal, time before, packets that follow.

    The last rows of a batch wait for the next one, as their key may go on there; that is all a task holds.
    """
    hold, place = max(1, ahead), 0
    fresh, before, last = True, 0, None                    # does the first waiting row open a key, its ordinal, the time before it
    waiting: pa.Table | None = None

    def numbered(rows: pa.Table, out: int) -> pa.RecordBatch:
        nonlocal fresh, before, last, place, waiting
        rows = rows.combine_chunks()
        n, nth = rows.num_rows, np.arange(rows.num_rows)
        opens = np.zeros(n, dtype=bool)
        opens[0] = fresh
        for name in FLOW_KEY:
            here, there = rows[name].slice(1), rows[name].slice(0, n - 1)
            differs = pc.or_(pc.fill_null(pc.not_equal(here, there), False), pc.not_equal(pc.is_null(here), pc.is_null(there)))
            opens[1:] |= differs.to_numpy()
        start = np.maximum.accumulate(np.where(opens, nth, -1))
        ordinal = np.where(start < 0, before + nth, nth - start)
        follows = np.append(np.where(opens, nth, n)[1:], n)
        left = np.minimum(np.minimum.accumulate(follows[::-1])[::-1] - nth - 1, ahead)
        earlier = pa.chunked_array([pa.array([last], pa.int64()), *rows["us"].slice(0, n - 1).chunks])
        earlier = pc.if_else(pa.array(opens), pa.scalar(None, pa.int64()), earlier)
        for name, values in (("_part", np.full(n, part, np.int32)), ("_pos", place + nth), ("ord", ordinal), ("left", left.astype(np.int32))):
            rows = rows.append_column(name, pa.array(values))
        rows = rows.append_column("prev_us", earlier)
        if out < n:
            waiting = rows.slice(out).drop_columns(["_part", "_pos", "ord", "left", "prev_us"])
            fresh, before, last, place = bool(opens[out]), int(ordinal[out]), rows["us"][out - 1].as_py(), place + out
        return rows.slice(0, out).combine_chunks().to_batches()[0]

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
        if waiting.num_rows > hold:
            yield numbered(waiting, waiting.num_rows - hold)
    if waiting is not None and waiting.num_rows:
        yield numbered(waiting, waiting.num_rows)


CARRIES = "_part INT, _tail LONG, _before LONG, _carry_us LONG, _after LONG"


def range_carries(numbered: DataFrame, ahead: int) -> list[tuple]:
    """Per range: where its last key starts, packets of its first key in earlier ranges and their last time, packets of its last key in later ones."""
    key = F.struct(*FLOW_KEY)
    edges = sorted(
        numbered.groupBy("_part").agg(
            F.count("*").alias("n"), F.count_if(F.col("_pos") == F.col("ord")).alias("head"),
            F.min_by(key, "_pos").alias("first"), F.max_by(key, "_pos").alias("last"),
            F.max_by("ord", "_pos").alias("ord"), F.max_by("us", "_pos").alias("us")).collect(),
        key=lambda e: e["_part"])                           # one row per range
    before, carry_us, after = [0] * len(edges), [None] * len(edges), [0] * len(edges)
    for i in range(1, len(edges)):
        if edges[i]["first"] == edges[i - 1]["last"]:
            whole = edges[i - 1]["head"] == edges[i - 1]["n"]
            before[i] = edges[i - 1]["ord"] + 1 + (before[i - 1] if whole else 0)
            carry_us[i] = edges[i - 1]["us"]
    for i in range(len(edges) - 2, -1, -1):
        if edges[i]["last"] == edges[i + 1]["first"]:
            whole = edges[i + 1]["head"] == edges[i + 1]["n"]
            after[i] = min(ahead, edges[i + 1]["head"] + (after[i + 1] if whole else 0))
    return [(e["_part"], e["n"] - 1 - e["ord"], b, c, a) for e, b, c, a in zip(edges, before, carry_us, after, strict=True)]


def order_in_key(keyed: DataFrame, ahead: int = FLOW_SIZE - 1, parts: int | None = None) -> DataFrame:
    """Add ``ord`` (0-based position in the key by time), ``prev_us`` (time of the packet before) and ``left`` (packets of the
    key that follow, counted up to ``ahead``).

    The rows lie in a written table that fixes the ranges; `discard` deletes it. ``parts``: number of ranges, by default
    that of the session's shuffles.
    """
    by = [*FLOW_KEY, "us", "packet_id"]
    ranges = keyed.repartitionByRange(parts, *by) if parts else keyed.repartitionByRange(*by)
    schema = T.StructType([*keyed.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_pos", T.LongType()),
                           T.StructField("ord", T.LongType()), T.StructField("left", T.IntegerType()), T.StructField("prev_us", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return number_in_range(batches, TaskContext.get().partitionId(), ahead)

    written = materialize(ranges.sortWithinPartitions(*by).mapInArrow(number, schema), "ordered")
    carries = keyed.sparkSession.createDataFrame(range_carries(written, ahead), CARRIES)
    tail = F.col("_pos") - F.col("ord") == F.col("_tail")
    ordered = written.join(F.broadcast(carries), "_part").select(
        *keyed.columns,
        (F.col("ord") + F.when(F.col("_pos") == F.col("ord"), F.col("_before")).otherwise(0)).alias("ord"),
        F.least(F.lit(ahead), F.col("left") + F.when(tail, F.col("_after")).otherwise(0)).cast("int").alias("left"),
        F.when(F.col("_pos") == 0, F.col("_carry_us")).otherwise(F.col("prev_us")).alias("prev_us"))
    ordered._written_to = written._written_to
    return ordered


def in_closed_window(size: int = FLOW_SIZE) -> Column:
    """Whether the window of an ordered packet has all its packets; needs ``left`` counted up to ``size - 1`` at least."""
    return F.col("ord") % size + F.col("left") >= size - 1


def window_packets(ordered: DataFrame, size: int = FLOW_SIZE) -> DataFrame:
    """Number the windows of ``size`` packets and add each packet's inter-arrival time in its window."""
    return ordered.select(
        "*",
        F.floor(F.col("ord") / size).alias("win"),
        F.when(F.col("ord") % size == 0, F.lit(0)).otherwise(F.col("us") - F.col("prev_us")).alias("iat"),
    ).drop("prev_us")


def count_windows(keyed: DataFrame, size: int = FLOW_SIZE, parts: int | None = None) -> DataFrame:
    """Packets of closed windows only; the incomplete tail of a key never comes out."""
    return window_packets(order_in_key(keyed, size - 1, parts).where(in_closed_window(size)).drop("left"), size)


def flow_iat(keyed: DataFrame, size: int = FLOW_SIZE, parts: int | None = None) -> DataFrame:
    """One row per packet of a closed window with its inter-arrival time in microseconds."""
    return count_windows(keyed, size, parts).select(*FLOW_KEY, "win", "packet_id", "us", "iat")


def flow_features(keyed: DataFrame, size: int = FLOW_SIZE, endpoints: bool = False, parts: int | None = None) -> DataFrame:
    """One row per closed window: key, window number and the 15 features (times in microseconds)."""
    used = keyed.select(*FLOW_KEY, "us", "packet_id", "fwd", "length")
    return window_features(order_in_key(used, size - 1, parts), size, endpoints)


def window_features(ordered: DataFrame, size: int = FLOW_SIZE, endpoints: bool = False) -> DataFrame:
    """`flow_features` of packets that `order_in_key` numbered."""
    fwd, bwd = F.col("fwd") == 1, F.col("fwd") == 0
    lengths = lambda fn, side: F.coalesce(fn(F.when(side, F.col("length"))), F.lit(0))
    aggregates = [
        (F.max("us") - F.min("us")).alias("flow_duration"),
        F.sum("fwd").alias("fwd_packets"), F.sum(1 - F.col("fwd")).alias("bwd_packets"),
        lengths(F.sum, fwd).alias("fwd_len_total"), lengths(F.sum, bwd).alias("bwd_len_total"),
        lengths(F.max, fwd).alias("fwd_len_max"), lengths(F.min, fwd).alias("fwd_len_min"),
        lengths(F.avg, fwd).alias("fwd_len_mean"),
        lengths(F.max, bwd).alias("bwd_len_max"), lengths(F.min, bwd).alias("bwd_len_min"),
        lengths(F.avg, bwd).alias("bwd_len_mean"),
        (F.sum("iat") / F.lit(float(size))).alias("flow_iat_mean"), F.max("iat").alias("flow_iat_max"),
    ]
    first = []
    if endpoints:
        # Key and direction of the first packet give back its addresses, so one INT per window is enough.
        aggregates.append(F.max(F.when(F.col("ord") % size == 0, F.col("fwd"))).alias("opened_fwd"))
        side = lambda a, b: F.when(F.col("opened_fwd") == 1, F.col(a)).otherwise(F.col(b))
        first = [side("ip_a", "ip_b").alias("src_ip"), side("ip_b", "ip_a").alias("dst_ip"),
                 side("port_a", "port_b").alias("src_port"), side("port_b", "port_a").alias("dst_port")]
    grouped = window_packets(ordered.where(in_closed_window(size)), size).groupBy(*FLOW_KEY, "win").agg(*aggregates)
    return grouped.select(
        *FLOW_KEY, "win", *first,
        "flow_duration", "fwd_packets", "bwd_packets", "fwd_len_total", "bwd_len_total",
        "fwd_len_max", "fwd_len_min", "fwd_len_mean", "bwd_len_max", "bwd_len_min", "bwd_len_mean",
        guarded_rate(F.col("fwd_len_total") + F.col("bwd_len_total"), F.col("flow_duration")).alias("flow_bytes_s"),
        guarded_rate(F.col("fwd_packets") + F.col("bwd_packets"), F.col("flow_duration")).alias("flow_packets_s"),
        "flow_iat_mean", "flow_iat_max")


def flow_endpoints(keyed: DataFrame, size: int = FLOW_SIZE, parts: int | None = None) -> DataFrame:
    """Who opened each closed window: initiator and responder of its first packet."""
    return flow_features(keyed, size, endpoints=True, parts=parts).select(
        *FLOW_KEY, "win", "src_ip", "dst_ip", "src_port", "dst_port")
