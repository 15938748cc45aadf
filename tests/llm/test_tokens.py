"""Byte BPE, packing and training order against the tokenizer libraries."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowsieve.llm import bpe, packing, tokens, training_order
from flowsieve.session import scratch_path

STRANGE = ["", "a", "  ", "don't   stop\n\n now", "naïve Ünïcödé 漢字かな交じり文 🙂🙂 ‍", "١٢٣ 456 ²", "x" * 700, "=" * 400 + " end", "   tab\t\x1f",
           "<|endoftext|> is text", "\u0085line", "AAAAaaaa" * 40, "1234567890" * 30, "\x00\x01"]


@pytest.fixture(scope="module")
def texts(odd_rows):
    return [(i, r[1]) for i, r in enumerate(odd_rows)] + [(100 + i, t) for i, t in enumerate(STRANGE)]


@pytest.fixture(scope="module")
def table(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(3)


def test_byte_bpe_equals_the_library_and_round_trips(table, texts, empty):
    library = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.RANKS), special_tokens={})
    got = {r["doc_id"]: (bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.encode_decode(table, rows=5).collect()}
    for i, t in texts:
        assert got[i] == (np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()), t
    assert bpe.encode_decode(empty).count() == 0


def test_words_of_a_bundle_are_folded_together(table):
    """One fold for many words of any length, the overlong ones among them; no interpreted expression per word."""
    library = tiktoken.Encoding("m", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.RANKS), special_tokens={})
    words = ["", "a", " the", "aaaa" * 30, "=" * 500, "ü", "漢字", " international", "x" * bpe.LONG, "y" * (bpe.LONG + 1), "qzxj", "1234567"]
    ids, sizes = bpe.coded_words(pa.array(words), bpe.RANKS)
    for word, end, n in zip(words, np.cumsum(sizes), sizes, strict=True):
        assert ids[end - n:end].tolist() == library.encode_ordinary(word), word
    plan = bpe.encode_decode(table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Generate" not in plan and "lambdafunction" not in plan


def test_every_pair_has_one_place():
    first, second = bpe.pair_tables(bpe.RANKS)
    entries = [e for e in first + second if e >= 0]
    ranks = bpe.load_ranks(bpe.RANKS)
    pairs = sum(t[:i] in ranks and t[i:] in ranks for t in ranks for i in range(1, len(t)))
    assert len(entries) == len(set(entries)) == pairs


def library_ids(texts):
    tokenizer = Tokenizer.from_file(tokens.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts}


def test_packing_covers_every_token_once(table, texts, empty):
    want, cover, places = library_ids(texts), defaultdict(list), defaultdict(list)
    for r in packing.digests(packing.pack_documents(table, limit=256)).collect():
        piece = want[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(want[r["doc_id"]])
        cover[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans, whole in [(cover[i], len(x)) for i, x in want.items()] + [(p, None) for p in places.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == whole if whole is not None else at <= 256 and at & (at - 1) == 0
    assert packing.pack_documents(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=40))
def test_packing_balances_costs(sizes):
    cost = packing.Cost(1.0, 0.01)
    pieces = packing.pack(sizes, 64, cost)
    assert sum(p[2] for p in pieces) == sum(sizes)
    filled = defaultdict(int)
    for _, _, n, s, offset in pieces:
        assert offset == filled[s]
        filled[s] += n
    assert sorted(filled.values(), reverse=True) == sorted(
        [64] * sum(n // 64 for n in sizes) + packing.capacities(sum(n % 64 for n in sizes), 64), reverse=True)


def test_permutation_is_keyed_and_one_to_one():
    for n in (1, 2, 3, 17, 1000, 4097):
        for key in (1, 2):
            assert sorted(training_order.permute(np.arange(n), n, key)) == list(range(n))
    assert (training_order.permute(np.arange(1000), 1000, 1) != training_order.permute(np.arange(1000), 1000, 2)).mean() > 0.9


def test_shards_hold_every_sequence_and_resume(spark, table, texts, empty):
    want, seen = library_ids(texts), defaultdict(dict)
    path = scratch_path(spark, "test-shards")
    training_order.write_shards(training_order.training_order(table, key=9, stride=32), path, per_shard=7, stride=32)
    rows = sorted(training_order.read_from(spark, path).collect())
    assert [r["slot"] for r in rows] == list(range(sum(-(-len(x) // 32) for x in want.values())))
    for r in rows:
        width = len(r["ids"]) // 32
        seen[r["doc_id"]][r["start"]] = np.frombuffer(bytes(r["ids"]), f"<u{width}")[:r["length"]]
        assert r["shard"] == r["slot"] // 7 and r["byte_offset"] == r["slot"] % 7 * 32 * width
    for i, x in want.items():
        assert np.concatenate([seen[i][s] for s in sorted(seen[i])]).tolist() == x.tolist()
    assert sorted(training_order.read_from(spark, path, 11).collect()) == rows[11:]
    ordered, slots = training_order.placed(table, key=9, stride=32)
    assert slots == len(rows)
    by_slot = training_order.shards(ordered, 7, 32, slots)               # ranges computed: no second read, the same shards in order
    assert by_slot.select("shard").distinct().count() == by_slot.count() == -(-slots // 7)
    assert [r[0] for r in by_slot.select("shard").collect()] == list(range(-(-slots // 7)))
    assert "rangepartitioning" not in by_slot._jdf.queryExecution().executedPlan().toString()
    training_order.shards(ordered, 7, 32, slots).write.parquet(path + "-by-slot")
    assert sorted(training_order.read_from(spark, path + "-by-slot").collect()) == rows
    assert training_order.materialised(empty).count() == 0


def test_repeated_rows_and_clashing_columns(odd, odd_rows):
    assert bpe.encode_decode(odd).count() == len(odd_rows)
    assert packing.pack_documents(odd).filter("start = 0").count() == len(odd_rows)
    assert training_order.training_order(odd).filter("start = 0").count() == len(odd_rows)
