"""Training-order materialisation: token sequences in a keyed pseudo-random order, as fixed-stride shards.

Sequences are written once and numbered 0 .. n - 1 (partition offset plus place in the partition). A Feistel network on
the next even power of two permutes the numbers; values outside 0 .. n - 1 are walked on until they fall inside, so every
sequence gets a slot of its own without a sort or a random draw. Shards hold consecutive slots of equal byte size: slot s
lies in shard s // per_shard at byte (s % per_shard) * stride * width, so a reader resumes anywhere and reads on in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.llm import tokens
from flowsieve.session import scratch_path

ROUNDS = 6
#: Ids are skewed, so an entropy coder takes a third off them.
CODEC = "zstd"
SHARDS = ("shard long, first_slot long, slots int, stride int, width int, payload binary, doc_ids array<long>, "
          "starts array<long>, lengths array<int>")


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser, keyed by ``salt``."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(salt & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of numbers below ``n``: a bijection of 0 .. n - 1 chosen by ``key``."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * 1_000_003 + r) & mask)
        return left << half | right

    out = once(index.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def sequences(docs: DataFrame, stride: int, vocabulary: str, end_id: int) -> DataFrame:
    """Windows of ``stride`` tokens of each document with its ``end_id``, the last one padded with ``end_id``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for docs_, ids, starts in tokens.token_batches(batches, vocabulary, end_id):
            wide = "<u2" if ids.max(initial=0) < 65536 else "<u4"
            rows: list[tuple] = []
            for d, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
                for s in range(a, b, stride):
                    piece = ids[s:min(s + stride, b)]
                    full = np.full(stride, end_id, "<u4")
                    full[:len(piece)] = piece
                    rows.append((part, nth, docs_[d], s - a, len(piece), full.tobytes() if wide == "<u4" else full.astype("<u2").tobytes()))
                    nth += 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["part", "nth", "doc_id", "start", "length", "ids"])

    return tokens.split_documents(docs).mapInArrow(cut, "part int, nth long, doc_id long, start long, length int, ids binary")


def placed(docs: DataFrame, key: int = 20_240_501, stride: int = 512, vocabulary: str = tokens.RANKS,
           end_id: int = 0) -> tuple[DataFrame, int]:
    """slot, doc_id, start, length, ids (little endian, 2 bytes each, or 4 where the batch needs them) of every sequence.

    A null or empty text gives one sequence with ``end_id`` alone; repeated rows give sequences of their own; a null id
    stays null; an empty table gives no rows. The written table fixes the numbering, so a lost executor cannot change it. With the rows
    comes their number.
    """
    rows, path = sequences(docs, stride, vocabulary, end_id), scratch_path(docs.sparkSession, "sequences")
    rows.write.option("compression", CODEC).parquet(path)
    written = docs.sparkSession.read.schema(rows.schema).parquet(path)
    # one row for each input partition: small on every cluster
    counts = sorted((r["part"], r["n"]) for r in written.groupBy("part").agg(F.count("*").alias("n")).collect())
    total, offsets = 0, {}
    for part, n in counts:
        offsets[part] = total
        total += n

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                index = batch["nth"].to_numpy() + np.array([offsets[p] for p in batch["part"].to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(permute(index, total, key)), *(batch[c] for c in ("doc_id", "start", "length", "ids"))],
                    names=["slot", "doc_id", "start", "length", "ids"])

    return written.mapInArrow(place, "slot long, doc_id long, start long, length int, ids binary"), total


def training_order(docs: DataFrame, key: int = 20_240_501, stride: int = 512, vocabulary: str = tokens.RANKS,
                   end_id: int = 0) -> DataFrame:
    """The rows of `placed`."""
    return placed(docs, key, stride, vocabulary, end_id)[0]


def shards(ordered: DataFrame, per_shard: int = 1024, stride: int = 512, slots: int | None = None) -> DataFrame:
    """One row per shard: the ids of ``per_shard`` consecutive slots as one byte string, and what each slot holds.

    Shards are range partitioned, so files follow the training order and every shard comes from one task. Slots are dense: with their
    number ``slots`` a shard's range is computed; without it Spark reads the rows once more to find the ranges.
    """
    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []

        def shard() -> pa.RecordBatch:
            width = max(len(r[4]) for r in rows) // stride
            body = b"".join(r[4] if len(r[4]) == width * stride else np.frombuffer(r[4], "<u2").astype("<u4").tobytes() for r in rows)
            columns = [[at], [rows[0][0]], [len(rows)], [stride], [width], [body], [[r[1] for r in rows]], [[r[2] for r in rows]], [[r[3] for r in rows]]]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                              names=["shard", "first_slot", "slots", "stride", "width", "payload", "doc_ids", "starts", "lengths"])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("slot", "doc_id", "start", "length", "ids")), strict=True):
                if row[0] // per_shard != at:
                    if rows:
                        yield shard()
                    at, rows = row[0] // per_shard, []
                rows.append(row)
        if rows:
            yield shard()

    numbered = ordered.withColumn("shard", F.expr(f"slot div {per_shard}"))
    parts = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if slots is None:
        ranged = numbered.repartitionByRange(parts, "shard")
    else:
        ranged = numbered.repartitionById(parts, F.expr(f"cast(shard * {parts}L div {max(1, -(-slots // per_shard))}L as int)"))
    return (ranged.sortWithinPartitions("shard", "slot")
            .select("slot", "doc_id", "start", "length", "ids").mapInArrow(bind, SHARDS))


def write_shards(ordered: DataFrame, path: str, per_shard: int = 1024, stride: int = 512, slots: int | None = None) -> None:
    shards(ordered, per_shard, stride, slots).write.option("compression", CODEC).parquet(path)


def read_from(spark: SparkSession, path: str, slot: int = 0) -> DataFrame:
    """slot, doc_id, start, length, ids from ``slot`` on: shards before it are not read."""
    rows = spark.read.schema(SHARDS).parquet(path).filter(F.col("first_slot") + F.col("slots") > slot)
    step = F.col("stride") * F.col("width")
    nth = F.posexplode("doc_ids").alias("nth", "doc_id")
    return (rows.select("*", nth).select(
        (F.col("first_slot") + F.col("nth")).alias("slot"), "shard", (F.col("nth") * step).cast("long").alias("byte_offset"), "doc_id",
        F.get("starts", F.col("nth")).alias("start"), F.get("lengths", F.col("nth")).alias("length"),
        F.substring("payload", F.col("nth") * step + 1, step).alias("ids")).filter(F.col("slot") >= slot))


def materialised(docs: DataFrame, key: int = 20_240_501, stride: int = 512, per_shard: int = 1024) -> DataFrame:
    """Write the shards of ``docs`` into the shared folder and read them back in slots."""
    spark = docs.sparkSession
    path = scratch_path(spark, "shards")
    ordered, slots = placed(docs, key, stride)
    write_shards(ordered, path, per_shard, stride, slots)
    return read_from(spark, path)
