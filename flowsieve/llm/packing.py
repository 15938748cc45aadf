"""Cost-balanced packing of documents into sequences of bounded length.

The cost of a piece of n tokens is linear * n + quadratic * n^2 (dense layers, attention within the piece). Tasks take
bundles of documents as they read them: full-length pieces fill sequences of their own; the remainders, longest first,
go to the sequence of lowest cost that has room, and are cut only when none has room for the whole. A bundle opens just
as many places as it has tokens: full sequences, then powers of two for the rest, so nothing is padded. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm import tokens

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Cost:
    """Relative costs for a model of width 1024: 12 d^2 against 2 n d multiplications a token."""

    linear: float = 1.0
    quadratic: float = 1 / 6144

    def of(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n


def capacities(total: int, limit: int) -> list[int]:
    """Sizes of sequences that ``total`` tokens fill exactly: whole ones, then descending powers of two."""
    rest = total % limit
    return [limit] * (total // limit) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(sizes: list[int], limit: int, cost: Cost) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) pieces; every token once, every sequence full."""
    pieces, rests = [], []
    sequence = 0
    for doc, n in enumerate(sizes):
        for start in range(0, n - n % limit, limit):
            pieces.append((doc, start, limit, sequence, 0))
            sequence += 1
        if n % limit:
            rests.append((n % limit, doc, n - n % limit))
    room = np.array(capacities(sum(r[0] for r in rests), limit), dtype=np.int64)
    used, spent = np.zeros(len(room), dtype=np.int64), np.zeros(len(room))
    for n, doc, start in sorted(rests, key=lambda r: (-r[0], r[1])):
        while n:
            free = room - used
            fits = free >= n
            at = int(np.where(fits if fits.any() else free > 0, spent, np.inf).argmin())
            take = int(min(n, free[at]))
            pieces.append((doc, start, take, sequence + at, int(used[at])))
            used[at] += take
            spent[at] += cost.of(take)
            n, start = n - take, start + take
    return pieces


def pack_documents(docs: DataFrame, limit: int = 1024, end_id: int = 0, vocabulary: str = tokens.VOCABULARY,
                   cost: Cost | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, first token there, length, ids (unsigned 32 bit, little endian), the document's
    tokens with ``end_id``, the sequence and the place in it.

    A null text is empty and has ``end_id`` alone. Repeated rows are packed one by one; a null id stays null. Columns
    besides id and text are ignored. An empty table gives an empty result. Sequence ids are unique: the task's partition
    in the upper half, a counter in the lower.
    """
    cost = cost or Cost()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for docs_, ids, starts in tokens.token_batches(batches, vocabulary, end_id):
            sizes = np.diff(starts)
            found = pack(sizes.tolist(), limit, cost)
            raw = ids.tobytes()
            spans = [(4 * (int(starts[d]) + s), 4 * n) for d, s, n, _, _ in found]
            columns = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([
                pa.array([docs_[d] for d in columns[0]], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                pa.array([raw[a:a + n] for a, n in spans], pa.binary()), pa.array([int(sizes[d]) for d in columns[0]], pa.int64()),
                pa.array([base + s for s in columns[3]], pa.int64()), pa.array(columns[4], pa.int64()),
            ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            base += max(columns[3], default=-1) + 1

    return tokens.split_documents(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
