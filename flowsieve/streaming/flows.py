"""Continuous flow assembly, and alerts with a threshold that may change while running.

Two ways. `flow_job` runs the batch operator on every micro-batch: what waits (at most ``size - 1`` packets and the number of
closed windows per key) is a table with one version per batch, read together with the new packets. A batch that is replayed
reads the version before it and replaces its own output, and no task holds a key's whole share of a batch. `flow_stream` keeps the same in Spark's
state and can evict idle keys; there, state per key is the number of windows closed so far and at most ``size - 1`` waiting packets, and the keys
of one hash group are folded together. A micro-batch is
ordered by (time, packet id) inside each key before it is folded; across micro-batches arrival order counts, as in
a live capture. Without an idle limit a quiet key waits for ever. One task folds a group's share of a micro-batch, so
bound the micro-batch at the source (``maxFilesPerTrigger``) where single keys can flood.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.alerts import alerts, usable
from ..operators.flows import in_closed_window, keyed_packets, order_in_key, window_features
from ..schema import ALERT_THRESHOLD, FLOW_KEY, FLOW_SIZE
from ..session import attach, discard

OUTPUT = """ip_a STRING, ip_b STRING, port_a LONG, port_b LONG, proto INT, win LONG,
src_ip STRING, dst_ip STRING, src_port LONG, dst_port LONG,
flow_duration LONG, fwd_packets LONG, bwd_packets LONG, fwd_len_total LONG, bwd_len_total LONG,
fwd_len_max LONG, fwd_len_min LONG, fwd_len_mean DOUBLE, bwd_len_max LONG, bwd_len_min LONG, bwd_len_mean DOUBLE,
flow_bytes_s DOUBLE, flow_packets_s DOUBLE, flow_iat_mean DOUBLE, flow_iat_max LONG"""
#: Keys share a state with those of the same hash, so that a task folds many keys at once; the number stays that of the checkpoint.
KEY_GROUPS = 256
STATE = """ip_a ARRAY<STRING>, ip_b ARRAY<STRING>, port_a ARRAY<LONG>, port_b ARRAY<LONG>, proto ARRAY<INT>, closed ARRAY<LONG>, last ARRAY<LONG>,
waits ARRAY<LONG>, us ARRAY<LONG>, fwd ARRAY<LONG>, length ARRAY<LONG>"""


def _side(length: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """Sum, max, min and mean of the masked packet lengths per window; 0 where a direction is silent."""
    n, total = mask.sum(axis=1), np.where(mask, length, 0).sum(axis=1)
    return {"total": total, "max": np.where(mask, length, 0).max(axis=1),
            "min": np.where(n > 0, np.where(mask, length, np.iinfo(np.int64).max).min(axis=1), 0),
            "mean": np.where(n > 0, total / np.maximum(n, 1), 0.0)}


def fold_windows(keys: pd.DataFrame, win: np.ndarray, us: np.ndarray, fwd: np.ndarray, length: np.ndarray) -> pd.DataFrame:
    """Features of full windows: one row of ``keys`` and of each array per window, one column of an array per packet."""
    windows, size = us.shape
    duration = us[:, -1] - us[:, 0]
    gaps = np.diff(us, axis=1)
    f, b = _side(length, fwd == 1), _side(length, fwd == 0)
    seconds = np.where(duration > 0, duration, 1) / 1e6
    per_second = lambda amount: np.where(duration > 0, amount / seconds, 0.0)
    opened = pd.Series(fwd[:, 0] == 1)
    side = lambda a, b: keys[a].where(opened, keys[b])
    n_fwd = fwd.sum(axis=1)
    return pd.DataFrame({
        **{name: keys[name] for name in FLOW_KEY},
        "win": win,
        "src_ip": side("ip_a", "ip_b"), "dst_ip": side("ip_b", "ip_a"), "src_port": side("port_a", "port_b"), "dst_port": side("port_b", "port_a"),
        "flow_duration": duration, "fwd_packets": n_fwd, "bwd_packets": size - n_fwd,
        "fwd_len_total": f["total"], "bwd_len_total": b["total"],
        "fwd_len_max": f["max"], "fwd_len_min": f["min"], "fwd_len_mean": f["mean"],
        "bwd_len_max": b["max"], "bwd_len_min": b["min"], "bwd_len_mean": b["mean"],
        "flow_bytes_s": per_second(f["total"] + b["total"]), "flow_packets_s": per_second(size),
        "flow_iat_mean": gaps.sum(axis=1) / size, "flow_iat_max": gaps.max(axis=1, initial=0)})


def _key_values(proto: pd.Series) -> pd.Series:
    """Protocol numbers as they were before null made them fractions."""
    return pd.Series([None if p != p else int(p) for p in proto], dtype=object) if proto.isna().any() else proto.astype(np.int64)


def fold_keys(waiting: tuple, fresh: pd.DataFrame, size: int = FLOW_SIZE, idle_us: int | None = None) -> tuple[pd.DataFrame, tuple, np.ndarray]:
    """(closed flows, what waits now, which of its keys had packets) of many keys at once; ``waiting`` has the columns of ``STATE``.

    In a key, what waits comes before the new packets, which are ordered by (time, packet id). Keys keep their place in the state.
    """
    *parts, closed, last, waits, us, fwd, length = waiting
    old = pd.DataFrame(dict(zip(FLOW_KEY, parts))).astype({"proto": float})
    known = len(old)
    every = pd.concat([old, fresh[FLOW_KEY].astype({"proto": float})] if known else [fresh[FLOW_KEY].astype({"proto": float})], ignore_index=True)
    code = every.groupby(FLOW_KEY, dropna=False, sort=False).ngroup().to_numpy()
    keys = every[~pd.Series(code).duplicated()].reset_index(drop=True)
    new = len(keys) - known
    closed = np.concatenate([np.asarray(closed, np.int64), np.zeros(new, np.int64)])
    last = np.concatenate([np.asarray(last, np.int64), np.zeros(new, np.int64)])
    order = fresh.assign(_key=code[known:]).sort_values(["_key", "us", "packet_id"])
    k = np.concatenate([np.repeat(np.arange(known), np.asarray(waits, np.int64)), order["_key"].to_numpy()])
    placed = np.argsort(k, kind="stable")
    k, n = k[placed], len(k)
    us, fwd, length = (np.concatenate([np.asarray(was, np.int64), order[c].to_numpy(dtype=np.int64)])[placed]
                       for was, c in ((us, "us"), (fwd, "fwd"), (length, "length")))

    # Runs of packets without a gap above the idle limit; only the last run of a key can still grow.
    opens = np.append(True, k[1:] != k[:-1]) if n else np.zeros(0, bool)
    starts = opens if idle_us is None else opens | np.append(True, np.diff(us) > idle_us)[:n]
    run, first = np.cumsum(starts) - 1, np.flatnonzero(starts)
    length_of = np.diff(np.append(first, n))
    place, windows, owner = np.arange(n) - first[run], length_of // size, k[first]
    if idle_us is not None:             # where nothing waited, the gap may lie before the first new packet
        heads = np.flatnonzero(opens)
        heads = heads[(k[heads] < known) & (us[heads] - last[k[heads]] > idle_us)]
        closed[k[heads]] = 0
    base = np.where(opens[first], closed[owner], 0)
    used = place < windows[run] * size
    heads = np.flatnonzero(used)[::size]
    owners = keys.iloc[k[heads]].reset_index(drop=True)
    owners["proto"] = _key_values(owners["proto"])
    flows = fold_windows(owners, base[run[heads]] + place[heads] // size, *(x[used].reshape(-1, size) for x in (us, fwd, length)))

    ends = np.append(opens[first][1:], True)[:len(first)]              # the last run of each key
    closed[owner[ends]] = (base + windows)[ends]
    last[owner[ends]] = us[(first + length_of - 1)[ends]]
    rest = ends[run] & ~used
    seen = np.zeros(len(keys), bool)
    seen[code[known:]] = True
    waits = np.bincount(k[rest], minlength=len(keys))
    return flows, (*(keys[c] for c in FLOW_KEY), closed, last, waits, us[rest], fwd[rest], length[rest]), seen


def _evicted(waiting: tuple, keep: np.ndarray) -> tuple:
    """The state without the keys that are not kept."""
    *of_key, us, fwd, length = waiting
    packets = np.repeat(keep, of_key[-1])
    return (*(x[keep] for x in of_key), *(x[packets] for x in (us, fwd, length)))


def flow_stream(packets: DataFrame, size: int = FLOW_SIZE, idle: str | None = None, watermark: str = "60 seconds", groups: int = KEY_GROUPS) -> DataFrame:
    """Closed flows with features and end points from a packet stream, in append mode.

    ``idle`` (e.g. "60 seconds") turns on eviction: a longer gap between two packets of a key drops the packets that
    wait before it, and a key that stays quiet loses its state once the watermark has passed its last packet by that
    long. Either way the key starts again at window 0 after the gap, so window numbers do not depend on the watermark.
    A stream must go on with the number of ``groups`` that its checkpoint was written with.
    """
    idle_us = int(pd.Timedelta(idle).total_seconds() * 1e6) if idle else None
    timeout = GroupStateTimeout.EventTimeTimeout if idle else GroupStateTimeout.NoTimeout
    if idle:
        packets = packets.withWatermark("ts", watermark)
    keyed = keyed_packets(packets)
    columns = [*FLOW_KEY, "us", "packet_id", "fwd", "length"]
    keyed = keyed.select(*columns, *(["ts"] if idle else []), F.pmod(F.xxhash64(*FLOW_KEY), F.lit(groups)).alias("_group"))
    none = pd.DataFrame({c: pd.Series(dtype=object if c.startswith("ip") else np.int64) for c in columns})

    def fold(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fresh = none if state.hasTimedOut else pd.concat(list(batches), ignore_index=True)[columns]
        flows, waiting, seen = fold_keys(state.get if state.exists else ([],) * 11, fresh, size, idle_us)
        if len(flows):
            yield flows
        if idle_us is not None:
            passed = state.getCurrentWatermarkMs()
            until = (waiting[6] + idle_us) // 1000
            waiting, until = _evicted(waiting, seen | (until >= passed)), until[seen | (until >= passed)]
            if not len(until):
                state.remove()
                return
        state.update(tuple(_key_values(x).tolist() if i == 4 else x.tolist() for i, x in enumerate(waiting)))
        if idle_us is not None:
            state.setTimeoutTimestamp(max(int(until.min()), passed + 1))

    return keyed.groupBy("_group").applyInPandasWithState(fold, OUTPUT, STATE, "append", timeout)


# ---------------------------------------------------------------- flows by a carried table

CARRY = [*FLOW_KEY, "closed", "us", "packet_id", "fwd", "length"]


def carried_flows(keyed: DataFrame, carry: DataFrame | None, size: int = FLOW_SIZE) -> tuple[DataFrame, DataFrame]:
    """(closed flows, what waits now) of a micro-batch of keyed packets and what waited before it.

    ``carry`` holds the waiting packets, each with the windows its key has closed, and a row without packet for a key where none
    waits. Waiting and new packets of a key are ordered by (time, packet id). Both results read
    one written table of numbered packets, which `discard` of the flows deletes.
    """
    columns = [*FLOW_KEY, "us", "packet_id", "fwd", "length"]
    packets, closed = keyed.select(*columns), None
    if carry is not None:
        packets = packets.unionByName(carry.where("packet_id IS NOT NULL").select(*columns))
        closed = carry.groupBy(*FLOW_KEY).agg(F.max("closed").alias("closed"))
    ordered = order_in_key(packets, size - 1)

    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("closed", F.lit(0).cast("long")) if closed is None else attach(df, closed, FLOW_KEY).fillna(0, ["closed"])

    flows = named(window_features(ordered, size, endpoints=True)).withColumn("win", (F.col("win") + F.col("closed")).cast("long")).drop("closed")
    so_far = lambda packets: (F.col("closed") + F.floor(packets / size)).alias("closed")
    waiting = named(ordered.where(~in_closed_window(size))).withColumn("closed", so_far(F.col("ord"))).select(*CARRY)
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("us", "long"), ("packet_id", "long"), ("fwd", "int"), ("length", "long"))]
    last = ordered.where(F.col("left") == 0)
    ended = named(last.where((F.col("ord") + 1) % size == 0)).select(*FLOW_KEY, so_far(F.col("ord") + 1), *none)
    after = waiting.unionByName(ended)
    if closed is not None:          # keys whose windows had all closed and that were silent in this batch
        seen = last.select(*[F.col(c).alias(f"_{c}") for c in FLOW_KEY])
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FLOW_KEY]
        after = after.unionByName(closed.join(seen, same, "left_anti").select(*FLOW_KEY, "closed", *none))
    flows._written_to = ordered._written_to
    return flows, after


def _version(spark, carry: str, batch_id: int) -> DataFrame | None:
    """What waited before a batch: the version of the batch before it."""
    if batch_id == 0:
        return None
    try:
        return spark.read.parquet(f"{carry}/batch={batch_id - 1}")
    except Exception as error:  # noqa: BLE001 - batch ids start above 0 where a checkpoint was continued without this table
        if "PATH_NOT_FOUND" in str(error):
            raise RuntimeError(f"no version {batch_id - 1} of what waits under {carry}") from error
        raise


def flow_batch(packets: DataFrame, batch_id: int, out: str, carry: str, size: int = FLOW_SIZE) -> DataFrame:
    """Close the flows of one micro-batch: writes them and what waits now, both under the batch's own name, and returns them."""
    spark = packets.sparkSession
    flows, waiting = carried_flows(keyed_packets(packets), _version(spark, carry, batch_id), size)
    flows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    waiting.write.mode("overwrite").parquet(f"{carry}/batch={batch_id}")
    discard(flows)
    return spark.read.schema(flows.schema).parquet(f"{out}/batch={batch_id}")


def flow_job(packets: DataFrame, out: str, carry: str, checkpoint: str, size: int = FLOW_SIZE,
             then: Callable[[DataFrame, int], None] | None = None, **trigger):
    """Run the stream: every micro-batch of packets goes through `flow_batch`, its flows through ``then`` (such as `alert_batch`)."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        flows = flow_batch(batch, batch_id, out, carry, size)
        if then is not None:
            then(flows, batch_id)

    writer = packets.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


# ---------------------------------------------------------------- alerts

def current_threshold(spark, path: str, default: float = ALERT_THRESHOLD) -> float:
    """Latest threshold in a small table of (set_at, threshold); the default until one is written."""
    try:
        row = spark.read.parquet(path).agg(F.max_by("threshold", "set_at").alias("t")).first()
    except Exception as error:  # noqa: BLE001 - a table not written yet is not an error
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return default
        raise
    return default if row["t"] is None else float(row["t"])


def set_threshold(spark, path: str, threshold: float) -> None:
    """Append a new threshold; running alert streams use it from their next micro-batch."""
    line = spark.range(1).select(F.current_timestamp().alias("set_at"), F.lit(float(threshold)).alias("threshold"))
    line.write.mode("append").parquet(path)


def threshold_of_batch(spark, path: str, batch_id: int) -> float:
    """The threshold in force when a batch was first scored, noted beside the table so that a replay uses the same one."""
    used = f"{path}-used/batch={batch_id}"
    try:
        return float(spark.read.parquet(used).first()["threshold"])
    except Exception as error:  # noqa: BLE001 - not noted yet
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    limit = current_threshold(spark, path)
    spark.range(1).select(F.lit(limit).alias("threshold")).write.mode("overwrite").parquet(used)
    return limit


def alert_batch(flows: DataFrame, batch_id: int, score: Callable[[DataFrame], DataFrame], threshold_path: str, alert_path: str,
                rejected_path: str) -> None:
    """Score the flows of one micro-batch and write its alerts under its own name, so a replayed batch replaces its output."""
    limit = threshold_of_batch(flows.sparkSession, threshold_path, batch_id)
    flows.persist()
    try:
        alerts(score(flows.where(usable())), limit).write.mode("overwrite").parquet(f"{alert_path}/batch={batch_id}")
        flows.where(~usable()).write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
    finally:
        flows.unpersist()


def alert_stream(flows: DataFrame, score: Callable[[DataFrame], DataFrame], threshold_path: str, alert_path: str,
                 rejected_path: str, checkpoint: str, **trigger):
    """Alerts of a stream of closed flows, with the threshold in force at each micro-batch; unusable flows go to ``rejected_path``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        alert_batch(batch, batch_id, score, threshold_path, alert_path, rejected_path)

    writer = flows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"})).start()
