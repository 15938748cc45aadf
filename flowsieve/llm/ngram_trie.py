"""Language-model scores from Elias-Fano n-gram tries, one trie per shard of predicted words.

The model mixes counts of three orders:

    p(w | u, v) = (c(u v w) + f(v) * (c(v w) + m(v) * q(w))) / (c(u v) + f(v) * (c(v) + m(v)))

q is the unigram share with the mass of words seen once set aside for unknown words; f and m depend on v alone, so every
p(. | u, v) sums to one. The numerator needs counts that end in w, the denominator those that end in v: both lie where
the n-grams of that last word lie, so each token is moved once, to the shard of its word (of word and predecessor for
frequent words, whose own counts are known everywhere). There a trie is built from the tokens that may be learnt from,
and all tokens are looked up in it.

A trie has three levels: words, predecessors of a word, predecessors of a pair. A level holds, node by node, the context-relative
word ids of each parent's children, made one monotone sequence by adding what the parents before reach; a second monotone
sequence points from each parent to its first child. Both are Elias-Fano coded and searched as they are: two selects on the
pointers give a parent's range, a select on the high bits the few values that can match inside it, and a binary search over their
packed low bits the successor. Values are quantised to 16 bits. All parts lie in one unlinked, memory-mapped file.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import crc_mod, ready, rows_of, texts_as_bytes
from flowsieve.llm.partenum import _WORDS, _mix
from flowsieve.session import materialize

#: Frequent words with a short id; the table every task holds is bounded by it.
HEAD = 65_000
#: Keys below this are short ids: frequent words, begin and end.
SHORT = HEAD + 2
TAIL = 65_535
BEGIN, END = np.uint64(0xB0B0_0000_0000_0001), np.uint64(0xE0E0_0000_0000_0002)
SHARD_TOKENS = 1_000_000
ROWS = 1024
#: Partial sums a task holds before it passes them on.
HELD_SUMS = 1_000_000


class Bits:
    """A bit string in 64-bit words with the ones before each word, for selects of many places at once."""

    def __init__(self, words: np.ndarray, ones: np.ndarray) -> None:
        self.words, self.ones = words, ones

    @classmethod
    def of(cls, places: np.ndarray, size: int) -> Bits:
        """Ones at ascending ``places`` below ``size``."""
        words = _or_into(places >> 6, np.uint64(1) << (places & 63).astype(np.uint64), (size >> 6) + 1)
        return cls(words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint32)[:-1]]).astype(np.uint32))

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Places of the ones with these numbers, counted from 0."""
        word = np.searchsorted(self.ones, nth.astype(np.uint32), "right") - 1
        return (word << 6) + _nth_bit(self.words[word], nth - self.ones[word])

    def select_zero(self, nth: np.ndarray) -> np.ndarray:
        """Places of the zeros with these numbers, counted from 0."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.searchsorted(zeros, nth, "right") - 1
        return (word << 6) + _nth_bit(~self.words[word], nth - zeros[word])

    def rank(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each place, and whether there is one at it."""
        word, bit = self.words[places >> 6], (places & 63).astype(np.uint64)
        below = word & ((np.uint64(1) << bit) - np.uint64(1))
        return self.ones[places >> 6].astype(np.int64) + np.bitwise_count(below), (word >> bit & np.uint64(1)).astype(bool)


def _or_into(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Words of ``size``, each the union of the values that go to it; ``at`` ascends."""
    out = np.zeros(size, np.uint64)
    if len(at):
        starts = _runs(at)
        out[at[starts]] = np.bitwise_or.reduceat(values, starts)
    return out


def _nth_bit(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth one in each word: halves are told apart by their counts."""
    words, nth, place = words.copy(), nth.astype(np.uint8), np.zeros(len(words), np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        ones = np.bitwise_count(words & np.uint64((1 << width) - 1))
        up = nth >= ones
        nth -= ones * up
        shift = up.astype(np.uint8) * np.uint8(width)
        words >>= shift.astype(np.uint64)
        place += shift
    return place


class EliasFano:
    """Monotone sequence in two parts: low bits packed, high bits in unary."""

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: Bits) -> None:
        self.n, self.low, self.lows, self.highs = n, low, lows, highs

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low = max(0, (top // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(low)).astype(np.int64)
        lows = np.zeros(0, np.uint64)
        if low:
            kept, bit = values & np.uint64((1 << low) - 1), np.arange(n, dtype=np.int64) * low
            off, size = (bit & 63).astype(np.uint64), (n * low >> 6) + 2
            over = off + np.uint64(low) > 64
            lows = _or_into(bit >> 6, kept << off, size) | _or_into((bit[over] >> 6) + 1, kept[over] >> (np.uint64(64) - off[over]), size)
        return cls(n, low, lows, Bits.of(high + np.arange(n), int(high[-1]) + n + 1 if n else 1))

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(at), np.uint64)
        bit = at * self.low
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        above = np.where(off > 0, self.lows[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (self.lows[word] >> off | above) & np.uint64((1 << self.low) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at these positions."""
        return (self.highs.select(at) - at).astype(np.uint64) << np.uint64(self.low) | self._low(at)

    def successor(self, keys: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Position of the first value not below each key, from ``start`` to before ``end``, and whether it equals the key."""
        first = np.zeros(len(keys), np.int64) if start is None else start.copy()
        stop = np.full(len(keys), self.n, np.int64) if end is None else end.copy()
        high = keys >> np.uint64(self.low)
        last = (len(self.highs.words) * 64 - self.n) - 1            # zeros of the last word behind the sequence count as empty buckets
        inside = high <= np.uint64(max(last, 0)) if self.n else np.zeros(len(keys), dtype=bool)
        first[~inside] = stop[~inside]
        bucket = high[inside].astype(np.int64)
        ends = np.minimum(self.highs.select_zero(bucket) - bucket, self.n)
        starts = np.zeros(len(bucket), np.int64)
        starts[bucket > 0] = self.highs.select_zero(bucket[bucket > 0] - 1) - bucket[bucket > 0] + 1
        first[inside] = np.maximum(first[inside], np.minimum(starts, stop[inside]))
        stop[inside] = np.maximum(np.minimum(stop[inside], ends), first[inside])
        lows, a, b = keys & np.uint64((1 << self.low) - 1), first, stop.copy()
        live = np.flatnonzero(a < b)
        while len(live):
            middle = (a[live] + b[live]) >> 1
            less = self._low(middle) < lows[live]
            a[live[less]], b[live[~less]] = middle[less] + 1, middle[~less]
            live = live[a[live] < b[live]]
        hit = a < stop
        hit[hit] = self._low(a[hit]) == lows[hit]
        return a, hit


def quantise(values: np.ndarray) -> tuple[float, float, np.ndarray]:
    """Start, step and 16-bit codes."""
    lo = float(values.min(initial=0.0))
    step = max((float(values.max(initial=0.0)) - lo) / 65535, 1e-12)
    return lo, step, np.round((values - lo) / step).astype(np.uint16)


class Trie:
    """Levels of n-grams by their last word, in one memory-mapped file."""

    def __init__(self) -> None:
        self._parts: list[np.ndarray] = []
        self._size = 0

    def _put(self, a: np.ndarray) -> tuple:
        self._parts.append(np.ascontiguousarray(a))
        at, self._size = self._size, self._size + a.nbytes + (-a.nbytes) % 8
        return at, len(a), a.dtype

    def _get(self, place: tuple) -> np.ndarray:
        at, n, kind = place
        return np.frombuffer(self._map, kind, n, at)

    def _bits(self, bits: Bits) -> tuple:
        return self._put(bits.words), self._put(bits.ones)

    def _sequence(self, values: np.ndarray) -> tuple:
        ef = EliasFano.of(values)
        return ef.n, ef.low, self._put(ef.lows), self._bits(ef.highs)

    def _open(self, place: tuple) -> EliasFano:
        n, low, lows, bits = place
        return EliasFano(n, low, self._get(lows), Bits(*map(self._get, bits)))

    def _names(self, keys: np.ndarray) -> tuple:
        """Sorted word keys: short ids as a bitmap, hashes of other words as a sequence."""
        few = int(np.searchsorted(keys, SHORT))
        return few, self._bits(Bits.of(keys[:few].astype(np.int64), SHORT)), self._sequence(keys[few:])

    def name(self, place: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of each word key in a list of names, and whether it is there."""
        few, bits, others = place
        at, hit = np.zeros(len(keys), np.int64), np.zeros(len(keys), dtype=bool)
        short = keys < SHORT
        at[short], hit[short] = Bits(*map(self._get, bits)).rank(keys[short].astype(np.int64))
        at[~short], hit[~short] = self._open(others).successor(keys[~short])
        at[~short] += few
        return at, hit

    @classmethod
    def build(cls, words: np.ndarray, lexicon: np.ndarray, second: tuple, third: tuple, values: list[np.ndarray]) -> Trie:
        """``words``: sorted keys; ``second`` / ``third``: (parent position, word id) per node, sorted; values: five arrays."""
        trie = cls()
        trie.words, trie.lexicon = trie._names(words), trie._names(lexicon)
        trie.levels = []
        for parents, (parent, ids) in zip((len(words), len(second[0])), (second, third), strict=True):
            starts = np.searchsorted(parent, np.arange(parents + 1))            # every parent has a child
            reach = np.cumsum(ids[starts[1:] - 1].astype(np.uint64) + np.uint64(1))
            base = np.concatenate([np.zeros(min(1, parents), np.uint64), reach[:-1]])
            trie.levels.append((trie._sequence(starts), trie._sequence(base[parent] + ids.astype(np.uint64))))
        trie.coded = []
        for v in values:
            lo, step, codes = quantise(v)
            trie.coded.append((lo, step, trie._put(codes)))
        with tempfile.TemporaryFile() as f:
            for a in trie._parts:
                f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
            f.write(b"\0")
            f.flush()
            trie._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        trie._parts = []
        return trie

    def value(self, which: int, at: np.ndarray) -> np.ndarray:
        lo, step, place = self.coded[which]
        return lo + step * self._get(place)[at]

    def _children(self, level: int, parent: np.ndarray, ids: np.ndarray, family: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of word ids among the children of the nodes ``parent[family]``: pointers are read once per family."""
        pointers, level = (self._open(x) for x in self.levels[level])
        start, end = pointers.get(parent).astype(np.int64), pointers.get(parent + 1).astype(np.int64)
        base = np.zeros(len(parent), np.uint64)
        base[start > 0] = level.get(start[start > 0] - 1) + np.uint64(1)
        return level.successor(base[family] + ids, start[family], end[family])

    def find(self, last: np.ndarray, before: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the words, pairs and triples (first, before, last), -1 where unknown; keys sorted by last, before, first."""
        words, pairs = _runs(last), _runs(last, before)
        up = np.searchsorted(words, pairs, "right") - 1                         # of pairs to words, of triples to pairs
        over = np.searchsorted(pairs, np.arange(len(last)), "right") - 1

        def below(level: int, parent: np.ndarray, family: np.ndarray, context: np.ndarray) -> np.ndarray:
            out = np.full(len(family), -1, np.int64)
            ids, known = self.name(self.lexicon, context)
            live = np.flatnonzero(known & (parent[family] >= 0))
            there = np.flatnonzero(parent >= 0)
            nth = np.zeros(len(parent), np.int64)
            nth[there] = np.arange(len(there))
            at, hit = self._children(level, parent[there], ids[live].astype(np.uint64), nth[family[live]])
            out[live[hit]] = at[hit]
            return out

        place, hit = self.name(self.words, last[words])
        word = np.where(hit, place, -1)
        pair = below(0, word, up, before[pairs])
        triple = below(1, pair, over, first)
        return word[up][over], pair[over], triple


@dataclass(frozen=True)
class Smoothing:
    """m(v) = head_mass * c(v) and f(v) = head_weight for frequent v, constants for others."""

    head_mass: float = 3.0
    head_weight: float = 0.05
    tail_mass: float = 20.0
    tail_weight: float = 0.05


@dataclass(frozen=True)
class Corpus:
    """Global numbers of the learnt tokens: total, distinct, seen once, texts; frequent words and their counts."""

    total: int
    distinct: int
    once: int
    texts: int
    head: np.ndarray         # hashes in ascending order
    counts: np.ndarray

    @property
    def unknown(self) -> float:
        return max(self.once, 0.5) / max(self.total, 1) if self.total else 1.0

    def share(self, count: np.ndarray) -> np.ndarray:
        """q: the unigram share, unknown words as one."""
        if not self.total:
            return np.ones(len(count))
        keep = max(1 - self.unknown, 1e-6)
        return np.where(count > 0, keep * count / self.total, self.unknown)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, an end after each; tokens per text."""
    texts = [t.lower().split() for t in texts_as_bytes(batch["text"])]
    end = int(END)
    flat: list[int] = []
    for words in texts:
        flat += [_WORDS[w] for w in words]
        flat.append(end)
    return np.array(flat, dtype=np.uint64), np.array([len(w) + 1 for w in texts], dtype=np.int64)


def corpus_numbers(rows: DataFrame) -> Corpus:
    """Count every learnt token: tasks add up what they hold before words are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1])], names=["h", "c"])
        for batch in rows_of(batches, ROWS):
            h, c = np.unique(_tokens(batch)[0], return_counts=True)
            both = np.concatenate([held[0], h])
            keys, inverse = np.unique(both, return_inverse=True)
            held = keys, np.bincount(inverse, np.concatenate([held[1], c]), len(keys)).astype(np.int64)
            if len(keys) > 2_000_000:
                yield out()
                held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield out()

    learnt = rows.filter(~F.col("held_out")).select("text")
    words = materialize(learnt.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    total, distinct, once = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.count_if(F.col("c") == 1)).first()
    head = words.orderBy(F.col("c").desc(), "h").limit(HEAD).toArrow()
    hashes, counts = head["h"].to_numpy().view(np.uint64), head["c"].to_numpy()
    texts = int(counts[hashes == END].sum())
    keep = hashes != END
    hashes = np.concatenate([hashes[keep], np.array([BEGIN, END], np.uint64)])
    counts = np.concatenate([counts[keep], [texts, texts]])
    order = np.argsort(hashes)
    return Corpus(int(total), int(distinct), int(once), texts, hashes[order], counts[order])


MESSAGE = ("shard int, key long, learnt binary, counts binary, texts binary, ids binary, tail3 binary, tail2 binary, tail1 binary, "
           "doc_ids array<long>, n_tokens array<long>")
PARTIAL = "batch long, doc_ids array<long>, learnt binary, n_tokens array<long>, known binary, base binary, score binary"
FINAL = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def messages(rows: DataFrame, corpus: Corpus, n_shards: int) -> DataFrame:
    """Tokens with their two predecessors, packed per batch and shard: short ids for frequent words, hashes for others.

    A message names only the texts that have tokens in its shard, so its size follows from its tokens however many shards there are.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        for batch in rows_of(batches, ROWS):
            h, sizes = _tokens(batch)
            ends = np.cumsum(sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            nth_in = np.arange(len(h)) - np.repeat(ends - sizes, sizes)
            before = np.where(nth_in > 0, np.roll(h, 1), BEGIN)
            first = np.where(nth_in > 1, np.roll(h, 2), BEGIN)
            at = np.minimum(np.searchsorted(corpus.head, h), len(corpus.head) - 1)
            short = np.where(corpus.head[at] == h, at, TAIL).astype(np.uint16)
            begin = np.uint16(np.searchsorted(corpus.head, BEGIN))
            short2 = np.where(nth_in > 0, np.roll(short, 1), begin)
            short1 = np.where(nth_in > 1, np.roll(short, 2), begin)
            spread = np.where(short != TAIL, h ^ _mix(before), h)
            shard = (_mix(spread) % np.uint64(n_shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            there, bounds = np.unique(shard[order], return_index=True)        # shards a batch has nothing for cost nothing
            learnt = (~batch["held_out"].to_numpy(zero_copy_only=False)).astype(np.uint8)
            key = part << 40 | nth
            meta = -1 - int(_mix(np.array([key], np.uint64))[0] % np.uint64(max(97, n_shards)))
            out: list[tuple] = [(meta, key, learnt.tobytes(), None, None, None, None, None, None, batch["doc_id"].to_pylist(), sizes.tolist())]
            for s, pick in zip(there.tolist(), np.split(order, bounds[1:]), strict=False):
                ids = np.concatenate([short[pick], short2[pick], short1[pick]])
                texts, times = np.unique(doc[pick], return_counts=True)
                out.append((s, key, learnt[texts].tobytes(), times.astype(np.uint32).tobytes(), texts.astype(np.uint16).tobytes(), ids.tobytes(),
                            h[pick][short[pick] == TAIL].tobytes(), _six(before[pick][short2[pick] == TAIL]),
                            _six(first[pick][short1[pick] == TAIL]), None, None))
            nth += batch.num_rows
            kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 7 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=[x.split()[0] for x in MESSAGE.split(", ")])

    return rows.mapInArrow(pack, MESSAGE)


def _six(h: np.ndarray) -> bytes:
    """The low 48 bits: contexts only need to differ."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(short: np.ndarray, raw: bytes, width: int) -> np.ndarray:
    """Keys of words: the short id, or the hash with a mark above it."""
    tails = np.zeros((len(raw) // width, 8), np.uint8)
    tails[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    out = short.astype(np.uint64)
    out[short == TAIL] = (tails.reshape(-1).view(np.uint64) >> np.uint64(2)) | np.uint64(1 << 62)
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows in sorted columns."""
    new = np.ones(len(keys[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def build_trie(last: np.ndarray, before: np.ndarray, first: np.ndarray, corpus: Corpus, rule: Smoothing) -> tuple[Trie, np.ndarray]:
    """The trie of sorted n-grams (with repeats) and the count of each of its words."""
    n = len(last)
    third = _runs(last, before, first)
    second = _runs(last, before)
    words = _runs(last)
    count = lambda starts: np.diff(np.append(starts, n))
    c3, c2, c1 = count(third), count(second), count(words)
    is_head = last[words] < SHORT
    c1[is_head] = corpus.counts[last[words[is_head]].astype(np.int64)]
    q = corpus.share(c1)
    up2, up3 = np.searchsorted(words, second, "right") - 1, np.searchsorted(second, third, "right") - 1
    m, f = context_weights(before[second], corpus, rule)
    lower = f * (c2 + m * q[up2])
    own_m, own_f = context_weights(last[words], corpus, rule)
    context = own_f * (np.where(is_head, corpus.counts[np.minimum(last[words], len(corpus.counts) - 1).astype(np.int64)], c1) + own_m)
    lexicon = np.unique(np.concatenate([before[second], first[third]]))
    values = [np.log10(q), np.log10(context), np.log10(lower), np.log10(c2 + context[up2]), np.log10(c3 + lower[up3])]
    trie = Trie.build(last[words], lexicon, (up2, np.searchsorted(lexicon, before[second])), (up3, np.searchsorted(lexicon, first[third])), values)
    return trie, c1


def context_weights(keys: np.ndarray, corpus: Corpus, rule: Smoothing) -> tuple[np.ndarray, np.ndarray]:
    head = keys < SHORT
    m, f = np.full(len(keys), rule.tail_mass), np.full(len(keys), rule.tail_weight)
    m[head] = rule.head_mass * np.maximum(corpus.counts[keys[head].astype(np.int64)], 1)
    f[head] = rule.head_weight
    return m, f


def shard_scores(last: np.ndarray, before: np.ndarray, first: np.ndarray, learnt: np.ndarray, corpus: Corpus,
                 rule: Smoothing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether its word was learnt, log10(c + 0.5), and its part of the model's log10 probability."""
    order = np.lexsort((first, before, last))
    last, before, first, learnt = last[order], before[order], first[order], learnt[order]
    trie, counts = build_trie(last[learnt], before[learnt], first[learnt], corpus, rule)
    starts = _runs(last, before, first)          # every distinct n-gram is looked up once
    times = np.diff(np.append(starts, len(last)))
    a, b, c = last[starts], before[starts], first[starts]
    word, pair, triple = trie.find(a, b, c)
    m, f = context_weights(b, corpus, rule)
    own_m, own_f = context_weights(a, corpus, rule)
    head = a < SHORT
    count = np.zeros(len(a))
    count[head] = corpus.counts[a[head].astype(np.int64)]      # counted everywhere, and not only in this shard
    tail = (word >= 0) & ~head
    count[tail] = counts[word[tail]]
    top = np.log10(f * m) + np.log10(corpus.share(count))
    bottom = np.log10(own_f * (count + own_m))
    top[tail] = np.log10(f * m)[tail] + trie.value(0, word[tail])
    bottom[tail] = trie.value(1, word[tail])
    paired, all_three = pair >= 0, triple >= 0
    top[paired] = trie.value(2, pair[paired])
    top[all_three] = trie.value(4, triple[all_three])
    bottom[paired] = trie.value(3, pair[paired])
    end = np.uint64(np.searchsorted(corpus.head, END))
    part = top - np.where(a == end, 0.0, bottom)
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.repeat(np.arange(len(a)), times)
    return (count > 0)[back], np.log10(count + 0.5)[back], part[back]


def lm_scores(docs: DataFrame, held_out_mod: int = 5, rule: Smoothing | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows whose crc32 of the id modulo ``held_out_mod`` is 1 are scored only, all others are learnt from, too. A null or
    empty text is the end token alone; a null id counts as empty text for the remainder and stays null. Repeated rows
    count and are scored one by one. With nothing to learn every word is unknown. Columns besides doc_id and text are
    ignored; an empty table gives no rows.
    """
    rule = rule or Smoothing()
    rows = ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", crc_mod(F.col("doc_id"), held_out_mod) == 1)
    corpus = corpus_numbers(rows)
    n_shards = max(1, -(-int(corpus.total * held_out_mod / max(1, held_out_mod - 1)) // shard_tokens))

    def row_of(batch: int, about: tuple | None, sums: tuple | None) -> pa.RecordBatch:
        values = [[batch], *([x] for x in about or (None,) * 3), *([x.tobytes() if sums else None] for x in sums or (None,) * 3)]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[x.split()[0] for x in PARTIAL.split(", ")])

    def add_shard(rows: list[tuple], held: dict[int, tuple[np.ndarray, ...]]) -> None:
        """Add a shard's known tokens, base and score of each text to the sums of its batch."""
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        at = 0
        for _, key, learnt, counts, _, ids, tail3, tail2, tail1, _, _ in rows:
            counts = np.frombuffer(counts, np.uint32)
            if key not in held:
                held[key] = (np.zeros(ROWS, np.int64), np.zeros(ROWS), np.zeros(ROWS))
            three, two, one = np.frombuffer(ids, np.uint16).reshape(3, -1)
            for column, value in zip(columns, (
                    _unpack(three, tail3, 8), _unpack(two, tail2, 6), _unpack(one, tail1, 6),
                    np.repeat(np.frombuffer(learnt, np.uint8).astype(bool), counts), np.repeat(np.arange(at, at + len(counts)), counts)), strict=True):
                column.append(value)
            at += len(counts)
        last, before, first, learnt, texts = (np.concatenate(c) for c in columns)
        columns.clear()
        sums = [np.bincount(texts, part, at) for part in shard_scores(last, before, first, learnt, corpus, rule)]
        at = 0
        for row in rows:
            texts = np.frombuffer(row[4], np.uint16)
            for total, part in zip(held[row[1]], sums, strict=True):
                total[texts] += part[at:at + len(texts)].astype(total.dtype)
            at += len(texts)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards come one after the other; what they add to the texts of a batch is summed up before it is shuffled."""
        rows: list[tuple] = []
        held: dict[int, tuple[np.ndarray, ...]] = {}
        for batch in rows_of(batches, 64):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and row[0] != rows[0][0]:
                    add_shard(rows, held)
                    rows = []
                    if len(held) * ROWS > HELD_SUMS:
                        yield from (row_of(key, None, sums) for key, sums in held.items())
                        held = {}
                if row[0] < 0:
                    yield row_of(row[1], (row[9], row[2], row[10]), None)
                else:
                    rows.append(row)
        if rows:
            add_shard(rows, held)
        yield from (row_of(key, None, sums) for key, sums in held.items())

    def finish(group: pa.Table) -> pa.Table:
        """All parts of one batch of texts."""
        about = next(r for r in zip(*(group[c].to_pylist() for c in ("doc_ids", "learnt", "n_tokens")), strict=True) if r[0] is not None)
        n = len(about[0])
        sums = [np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
        for total, name in zip(sums, ("known", "base", "score"), strict=True):
            for part in group[name].to_pylist():
                if part is not None:
                    total += np.frombuffer(part, total.dtype)[:n]
        return pa.table([pa.array(about[0], pa.int64()), pa.array([not x for x in about[1]]), pa.array(about[2], pa.int64()), *map(pa.array, sums)],
                        names=[x.split()[0] for x in FINAL.split(", ")])

    parts = messages(rows, corpus, n_shards).repartition("shard").sortWithinPartitions("shard").mapInArrow(score, PARTIAL)
    summed = parts.groupBy("batch").applyInArrow(finish, FINAL)
    start = np.log10(corpus.texts + rule.head_weight * (corpus.texts + rule.head_mass * max(corpus.texts, 1)))
    whole = np.log10(corpus.total + 0.5 * (corpus.distinct + 1))
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(corpus.total).cast("long").alias("train_tokens"),
                         (F.col("base") - F.col("n_tokens") * float(whole)).alias("base_score"), (F.col("score") - float(start)).alias("score"))
