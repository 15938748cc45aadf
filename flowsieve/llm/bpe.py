"""Byte-level BPE encoding and decoding: a fold of ranked merges over many words at once.

Texts are split by the tokenizers' pattern in Spark. Tasks bundle documents and merge the distinct pre-tokens of a bundle: the
state of all words is the list of their token ids, each step joins in every word the leftmost pair of the lowest rank and
looks up the ranks of the pairs it makes, and words that are done leave the fold. Pairs are looked up in two hashed arrays
(every pair has one place in either). Documents put the ids of their words together by position; decoding joins the byte
pieces of the ids. Nothing is shuffled and no vocabulary of the corpus is ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from flowsieve.llm import tokens
from flowsieve.llm.tokens import load_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Pre-tokens of more bytes are merged by the tokenizer library: a step goes over whole words, so work grows with the square of the length.
LONG = 192
BUNDLE = 8192
#: Documents whose ids and bytes are put together at once.
PART = 512
SLOTS = 1 << 17
#: A rank that no pair has.
NONE = 1 << 30


def _places(pair: int) -> tuple[int, int]:
    return pair * 40_503 % 2_147_483_647 % SLOTS, pair * 30_011 % 2_147_483_629 % SLOTS


@lru_cache(maxsize=4)
def pair_tables(path: str) -> tuple[list[int], list[int]]:
    """Two arrays that hold every mergeable pair (left id * 65536 + right id) with its rank, each in one of its two places."""
    ranks = load_ranks(path)
    tables = [[-1] * SLOTS, [-1] * SLOTS]
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is None or right is None:
                continue
            entry, side = (left << 16 | right) << 16 | rank, 0
            for _ in range(500):
                at = _places(entry >> 16)[side]
                entry, tables[side][at] = tables[side][at], entry
                if entry < 0:
                    break
                side ^= 1
            else:
                raise ValueError("the rank map does not fit its arrays")
    return tables[0], tables[1]


@lru_cache(maxsize=4)
def _arrays(path: str) -> tuple[np.ndarray, ...]:
    """The pair tables, the ids of single bytes, and the bytes of all ids with where each begins."""
    ranks = load_ranks(path)
    by_id = {rank: token for token, rank in ranks.items()}
    pieces = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    begins = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])
    first, second = (np.array(t, np.int64) for t in pair_tables(path))
    return first, second, np.array([ranks[bytes([b])] for b in range(256)], np.int64), np.frombuffer(b"".join(pieces), np.uint8), begins


def _found(left: np.ndarray, right: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ids, NONE where they do not merge."""
    pair = left << 16 | right
    a, b = first[pair * 40_503 % 2_147_483_647 % SLOTS], second[pair * 30_011 % 2_147_483_629 % SLOTS]
    return np.where(a >> 16 == pair, a & 65535, np.where(b >> 16 == pair, b & 65535, NONE))


def merged(body: np.ndarray, sizes: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Fold ranked merges over many words at once: (ids of all words one after the other, ids per word).

    ``body`` holds the bytes of all words, ``sizes`` their lengths. The state is the list of ids and the ranks of neighbours. A step
    joins in every word the leftmost pair of the lowest rank and looks up the two pairs it makes; words without one are done.
    """
    first, second, single, _, _ = _arrays(path)
    ids, counts = single[body], sizes.astype(np.int64)
    done_ids, done_words, open_ = [], [], np.flatnonzero(counts > 0)
    final, counts = counts.copy(), counts[open_]
    nth = np.arange(len(ids))
    ends = np.cumsum(counts)
    ranks = np.full(len(ids), NONE, np.int64)                   # of an id and the one after it; NONE at a word's end
    inner = np.ones(len(ids), bool)
    inner[ends - 1] = False
    at = np.flatnonzero(inner)
    ranks[at] = _found(ids[at], ids[at + 1], first, second)
    while len(open_):
        starts = np.cumsum(counts) - counts
        best = np.minimum.reduceat(ranks * (1 << 32) + nth[:len(ranks)], starts)       # leftmost of the lowest rank
        over = best >> 32 >= NONE
        if over.any():
            out = np.repeat(over, counts)
            done_ids.append(ids[out])
            done_words.append(open_[over])
            final[open_[over]] = counts[over]
            shift = np.cumsum(out)[best[~over] & 0xFFFFFFFF]
            best = best[~over] - shift
            ids, ranks, open_, counts = ids[~out], ranks[~out], open_[~over], counts[~over]
            if not len(open_):
                break
        j = best & 0xFFFFFFFF                               # ids at j and j + 1 become one
        ids[j] = best >> 32
        keep = np.ones(len(ids), bool)
        keep[j + 1] = False
        ranks[j] = ranks[j + 1]
        ids, ranks, counts = ids[keep], ranks[keep], counts - 1
        ends, j = np.cumsum(counts), j - np.arange(len(j))
        right = j + 1 < ends
        ranks[j[right]] = _found(ids[j[right]], ids[j[right] + 1], first, second)
        left = j > ends - counts
        ranks[j[left] - 1] = _found(ids[j[left] - 1], ids[j[left]], first, second)
    words = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
    flat = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
    return _gather(flat, final[words], np.argsort(words, kind="stable")), final


def _gather(flat: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The picked ones of the pieces that lie one after the other in ``flat``."""
    begins, each = (np.cumsum(sizes) - sizes)[picked], sizes[picked]
    ends = np.cumsum(each)
    return flat[np.repeat(begins - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]


def _binaries(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Bytes of ``flat`` between neighbouring bounds."""
    bounds = pa.py_buffer(bounds.astype(np.int64).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) // 8 - 1, [None, bounds, pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def coded_words(words: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words one after the other, and how many each has."""
    import tiktoken
    raw = words.cast(pa.large_binary())
    lengths = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
    long_at = np.flatnonzero(lengths > LONG)
    short = pc.if_else(pa.array(lengths > LONG), pa.scalar(b"", pa.large_binary()), raw) if len(long_at) else raw
    body = np.frombuffer(b"".join(short.to_pylist()), np.uint8)
    ids, sizes = merged(body, np.where(lengths > LONG, 0, lengths), path)
    if len(long_at):
        library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
        more = [np.array(library.encode_ordinary(raw[i].as_py().decode()), np.int64) for i in long_at]
        ids = np.insert(ids, np.repeat(np.cumsum(sizes)[long_at], [len(m) for m in more]), np.concatenate(more))
        sizes[long_at] = [len(m) for m in more]
    return ids, sizes


def encode_decode(docs: DataFrame, ranks: str = RANKS, rows: int = BUNDLE) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32 bit) and decoded bytes of every text; null text: empty.

    One row for each input row, also for repeated ones; a null id stays null; other columns are ignored; an empty table
    gives no rows. Special tokens in a text are ordinary text.
    """
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *_, pieces, begins = _arrays(ranks)
        piece_sizes = np.diff(begins)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                lists = batch["tokens"]
                offsets = lists.offsets.to_numpy()
                coded = pc.dictionary_encode(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
                places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                ids, sizes = coded_words(coded.dictionary, ranks)
                bounds = np.concatenate([[0], np.cumsum(sizes[places])])[offsets - offsets[0]]
                ids = _gather(ids, sizes, places)
                for lo in range(0, batch.num_rows, PART):
                    hi = min(lo + PART, batch.num_rows)
                    own, edges = ids[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]
                    decoded = np.concatenate([[0], np.cumsum(piece_sizes[own])])[edges]
                    yield pa.RecordBatch.from_arrays(
                        [batch["doc_id"].slice(lo, hi - lo), _binaries(own.astype("<u4").view(np.uint8), edges * 4).cast(pa.binary()),
                         _binaries(_gather(pieces, piece_sizes, own), decoded).cast(pa.binary())], names=["doc_id", "ids", "decoded"])

    return tokens.split_documents(docs).mapInArrow(code, "doc_id long, ids binary, decoded binary")
