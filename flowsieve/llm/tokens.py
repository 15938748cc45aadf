"""Token ids of whole texts.

Spark splits texts into pre-tokens with the tokenizer's own pattern; tasks see them as Arrow lists, encode each distinct
pre-token of a batch once (a worker remembers a bounded number of them), and gather the ids by position in numpy.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import ready

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The same vocabulary as ranks, for the rank library.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pre-tokens a worker remembers before it starts anew.
REMEMBER = 300_000
_ENCODERS: dict[str, tuple[Callable, dict[str, bytes]]] = {}


def pretokens(text: Column) -> Column:
    """Every match of the tokenizers' pattern, with Unicode classes; the matches cover the text. Null text: none."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")), F.lit("(?U)" + public_tokenizers.PATTERN), F.lit(0))


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _encoder(path: str) -> tuple[Callable, dict[str, bytes]]:
    if path not in _ENCODERS:
        if path.endswith(".tiktoken"):
            import tiktoken
            ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
            _ENCODERS[path] = (lambda words: [np.array(ranks.encode_ordinary(w), "<u4").tobytes() for w in words]), {}
            return _ENCODERS[path]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text

        def encode(words: list[str]) -> list[bytes]:
            return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

        _ENCODERS[path] = encode, {}
    return _ENCODERS[path]


def encode_lists(lists: pa.ListArray, path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts one after the other, and where each text begins (one more entry than texts)."""
    encode, known = _encoder(path)
    offsets = lists.offsets.to_numpy()
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    coded = pc.dictionary_encode(flat)
    words = coded.dictionary.to_pylist()
    pieces: list[bytes] = [known.get(w, b"") for w in words]
    missing = [i for i, p in enumerate(pieces) if not p]
    for at in range(0, len(missing), 20_000):
        part = missing[at:at + 20_000]
        if len(known) + len(part) > REMEMBER:
            known.clear()
        for i, ids in zip(part, encode([words[i] for i in part]), strict=True):
            pieces[i] = known[words[i]] = ids
    sizes = np.array([len(p) // 4 for p in pieces], dtype=np.int64)
    pool = np.frombuffer(b"".join(pieces), "<u4")
    begins = np.cumsum(sizes) - sizes
    codes = coded.indices.to_numpy(zero_copy_only=False)
    each = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(each)])
    ids = pool[np.repeat(begins[codes] - ends[:-1], each) + np.arange(ends[-1])] if len(codes) else np.zeros(0, "<u4")
    starts = ends[offsets]
    if end_id is not None:
        ids = np.insert(ids, starts[1:], np.uint32(end_id))
        starts = starts + np.arange(len(starts))
    return ids.astype("<u4", copy=False), starts


def token_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int | None,
                  rows: int = 2048) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield (part["doc_id"].to_pylist(), *encode_lists(part["tokens"], path, end_id))


def split_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the pre-tokens of each text; other columns are ignored."""
    return ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), pretokens(F.col(text_col)).alias("tokens"))
