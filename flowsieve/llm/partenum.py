"""N-gram Jaccard join by PartEnum signatures: every pair of word-shingle sets at or above the threshold, exactly.

Sets that link differ in at most (a + b)(1 - t) / (1 + t) elements. Bands of sizes overlap so that each such pair shares one;
a band hashes the shingle domain into more parts than its sets can differ in. The part-wise signatures (part number and
what a set has there) of a linking pair agree but for d parts. Among the ``d + 1`` rarest signatures of either set at
least one is therefore common to both, whatever their order, as long as the order is the same for all: by document
frequency, counted over all sets. Signatures of shared passages are frequent and drop out, signatures that only one set
has need no partner. A part without elements is the most frequent signature; a set with too few filled parts also signs
under further partitions, and only beyond those by its empty parts.

Equal sets are one class from the start. Sets that meet in a kept signature, directly or by others, are a family; a family
is compared inside tasks of bounded size, each of its sets travelling once for every tile it is in and no pair ever being a
row. Within a tile, what has been reached from a component is not compared again, so a family of near copies costs
comparisons in proportion to its members, and no link between classes is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.llm.common import WHITE, ready, rows_of, texts_as_bytes
from flowsieve.session import attach, discard, materialize

ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
LEVELS = 4
SIG_MASK = np.uint64((1 << 48) - 1)
KNOWN_WORDS = 300_000
FILTER_BITS = 1 << 24


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles, lower-cased; fewer words: one for all of them.

    Words of all texts lie in one array, so a batch takes a few array operations, and windows across texts are skipped.
    """
    words = [t.lower().split() for t in texts]
    sizes = [len(w) for w in words]
    flat: list[int] = []
    for ws in words:
        flat += map(_WORDS.__getitem__, ws)
    values = np.array(flat, np.uint64)
    with np.errstate(over="ignore"):
        n = len(values) - size + 1
        total = np.full(max(n, 0), np.uint64(size), np.uint64)
        for j in range(size):
            if n > 0:
                total = total * ODD[0] + values[j:j + n]
        total = _mix(total)
        out, at = [], 0
        for m in sizes:
            if m >= size:
                out.append(np.unique(total[at:at + m - size + 1]))
            elif m:
                few = np.uint64(m)
                for v in values[at:at + m]:
                    few = few * ODD[0] + v
                out.append(_mix(np.array([few], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += m
    return out


def shingles(text: bytes, size: int = 5) -> np.ndarray:
    return shingle_sets([text], size)[0]


def fingerprint(items: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(items.tobytes()) - (1 << 63)


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least num / den."""

    num: int = 75
    den: int = 100
    ratio: float = 1.7
    slack: float = 0.4
    salt: int = 0

    def partner(self, a: int) -> int:
        """The largest size that can still link with ``a``."""
        return a * self.den // self.num

    def apart(self, a: int, b: int) -> int:
        """The most elements in which linking sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


@lru_cache(maxsize=8)
def limits(t: Threshold, top: int) -> tuple[int, ...]:
    """Upper sizes of the bands, as far as ``top``."""
    out = [max(2, t.num // (t.den - t.num))]
    while out[-1] < top:
        out.append(max(out[-1] + 1, int(out[-1] * t.ratio)))
    return tuple(out)


def bands(n: int, t: Threshold) -> list[tuple[int, int, int]]:
    """(band, parts, differences to expect) of each band in which a set of ``n`` elements can have partners."""
    upper = limits(t, 1 << max(4, (2 * n).bit_length()))
    out = []
    for j, u in enumerate(upper):
        low = upper[j - 1] if j else 0
        partner = min(u, t.partner(n))
        if n > u or partner <= low:
            continue
        if n > low or partner > low:
            d = t.apart(n, partner)
            if d:
                base = t.apart(u, u) + 1
                out.append((j, base + max(2, int(np.ceil(t.slack * base))), d))
        if n <= low and partner > low:
            break
    return out


def signatures(items: np.ndarray, t: Threshold) -> list[tuple[int, int, int, np.ndarray]]:
    """(group, filled parts, signatures to keep, signatures) for each band and level the set signs under."""
    out = []
    for band, parts, d in bands(len(items), t):
        for level in range(LEVELS):
            group = band * LEVELS + level
            with np.errstate(over="ignore"):
                mixed = _mix(items + np.uint64(group + 1 + t.salt) * ODD[1])
                part = (mixed >> np.uint64(11)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                filled, first = np.unique(part[order], return_index=True)
                content = np.add.reduceat(mixed[order] * ODD[2], first)
                sigs = _mix(content + (filled + np.uint64(1)) * ODD[3] + np.uint64(group + t.salt) * ODD[4])
                short = d + 1 - len(filled)
                if short > 0 and level == LEVELS - 1:
                    empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), filled)[:short]
                    sigs = np.concatenate([sigs, _mix((empty + np.uint64(1)) * ODD[3] + np.uint64(group + t.salt) * ODD[4])])
            out.append((group, len(sigs), d + 1, (sigs & SIG_MASK).astype(np.int64)))
            if short <= 0:
                break
    return out


def _documents(docs: DataFrame) -> DataFrame:
    return ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def classes(docs: DataFrame, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, the fingerprint of the set (null when it is empty) and a hash of the text, of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sets = shingle_sets(texts_as_bytes(batch["text"]), size)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()), batch["th"]],
                names=["doc_id", "n_shingles", "fp", "th"])

    return _documents(docs).withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, n_shingles long, fp long, th long")


def signature_rows(docs: DataFrame, t: Threshold, size: int = 5) -> DataFrame:
    """sig, fp, grp: one row per signature of each distinct set (a task signs equal sets once).

    ``grp`` holds the partition and, in its lower half, how many of the set's filled parts may be left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in rows_of(batches, 256):
            found: list[tuple] = []
            for items in shingle_sets(texts_as_bytes(batch["text"]), size):
                if len(items) and (fp := fingerprint(items)) not in seen:
                    if len(seen) < 1_000_000:
                        seen.add(fp)
                    found += [(fp, (group << 32) + filled - keep + (1 << 31), sigs) for group, filled, keep, sigs in signatures(items, t)]
            if found:
                times = [len(f[2]) for f in found]
                columns = [np.repeat(np.array([f[i] for f in found], np.int64), times) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[2] for f in found])), *map(pa.array, columns)], names=["sig", "fp", "grp"])

    return _documents(docs).select("text").mapInArrow(run, "sig long, fp long, grp long")


def kept_signatures(rows: DataFrame) -> DataFrame:
    """(sig, fp, df): for each set and partition, those of its rarest signatures that another set has too.

    All of a set's filled parts but those that may be left out are kept, in order of frequency; those that no other
    set has are the rarest and need no row.
    """
    same = Window.partitionBy("sig")
    shared = (rows.repartition("sig").withColumns({"df": F.count("*").over(same), "lo": F.min("fp").over(same), "hi": F.max("fp").over(same)})
              .filter("lo <> hi").select("sig", "fp", "grp", "df").distinct())
    own = Window.partitionBy("fp", "grp")
    ranked = shared.withColumns({"nth": F.row_number().over(own.orderBy("df", "sig")), "shared": F.count("*").over(own)})
    left_out = F.col("grp").bitwiseAND((1 << 32) - 1) - (1 << 31)
    return ranked.filter(F.col("nth") <= F.col("shared") - left_out).select("sig", "fp", "df")


#: Distinct sets, and elements of them, that one task compares with each other at most.
TILE, TILE_VALUES = 4096, 4_000_000


def candidate_groups(kept: DataFrame) -> DataFrame:
    """(sig, fp) of the sets that share a kept signature; groups of equal members count once."""
    marks = kept.groupBy("sig").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("fp")).alias("x"), F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"))
    first = marks.filter("n > 1").groupBy("n", "x", "y").agg(F.min("sig").alias("sig")).select("sig")
    return kept.join(first, "sig", "left_semi").select("sig", "fp")


def involved_sets(docs: DataFrame, members: DataFrame, rows: DataFrame, size: int = 5) -> DataFrame:
    """fp and shingles of one document of each class among ``members``.

    A bitmap of fixed size over the hashes of these documents' texts lets tasks pass over the others unread; what gets
    through by chance is dropped by the join.
    """
    wanted = members.select("fp").distinct()
    texts = rows.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("th").alias("th")).join(wanted, "fp", "left_semi")
    bit = F.pmod(F.col("th"), F.lit(FILTER_BITS)) + 1        # positions from 1, as the bitmap functions number them
    maps = (texts.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for row in maps:          # at most FILTER_BITS / 32768 rows of 4 KB
        start = (row["bucket"] - 1) * 32768
        bits[start:start + 32768] |= np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")[:32768].astype(bool)
    packed = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = np.unpackbits(packed).astype(bool)
        seen: set[int] = set()
        for batch in rows_of(batches, 256):
            batch = batch.filter(pa.array(lookup[batch["th"].to_numpy() % FILTER_BITS]))
            found = {}
            for items in shingle_sets(texts_as_bytes(batch["text"]), size):
                if len(items) and (fp := fingerprint(items)) not in seen:
                    found[fp] = items.astype(np.int64)
                    if len(seen) < 1_000_000:
                        seen.add(fp)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["fp", "items"])

    sets = _documents(docs).select("text", F.xxhash64("text").alias("th")).mapInArrow(run, "fp long, items array<long>")
    return sets.join(wanted, "fp", "left_semi").dropDuplicates(["fp"])


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node of each node's connected component, by alternating large and small stars.

    Each round rewrites the edges into the shared folder, until every edge leads to a root and every node to one only: a
    node with two targets still ties two stars together. Rounds grow with the logarithm of the longest chain. A node's smallest
    neighbour is found by partial aggregation and joined to its edges, so a hub's edges may lie in many tasks.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = materialize(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")), "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.withColumnRenamed("m", "v")).distinct()
        old, edges = edges, materialize(small, "edges")
        discard(old, large)
        if (edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
                and edges.groupBy("u").count().filter("count > 1").isEmpty()):
            break
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found._written_to = edges._written_to
    return found


def connect(items: list[np.ndarray], labels: np.ndarray, t: Threshold) -> np.ndarray:
    """Labels after all sets that link, directly or by others, have taken the smallest label among them.

    Sets of one label are known to belong together. Smallest groups first, a group's sets are compared with all sets not
    yet reached whose size allows a link; what they reach joins the group. So sets that belong together cost little, and only
    what stays apart is compared in full.
    """
    sizes = np.array([len(x) for x in items])
    order = np.argsort(sizes, kind="stable")
    items, labels, sizes = [items[i] for i in order], labels[order], sizes[order]
    distinct, ids = np.unique(np.concatenate(items), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    members = {label: np.flatnonzero(labels == label) for label in np.unique(labels)} if len(np.unique(labels)) < len(labels) else {label: np.array([i]) for i, label in enumerate(labels)}
    mark, left, result = np.zeros(len(distinct), np.uint8), np.ones(len(items), bool), labels.copy()
    place = np.arange(len(items))                 # sets not reached yet, in order of size, and their elements
    flat, at = ids, starts[:-1]
    for label in sorted(members, key=lambda label: len(members[label])):
        if not left[members[label][0]]:
            continue
        open_, reached = list(members[label]), list(members[label])
        left[open_] = False
        while open_:
            r = open_.pop()
            if 2 * left[place].sum() < len(place):
                place = place[left[place]]
                flat = np.concatenate([ids[starts[i]:starts[i + 1]] for i in place]) if len(place) else ids[:0]
                at = np.concatenate([[0], np.cumsum(sizes[place])])[:-1].astype(np.int64)
            if not len(place):
                break
            n = int(sizes[r])
            low, high = np.searchsorted(sizes[place], [-(-n * t.num // t.den), t.partner(n) + 1])
            if low == high:
                continue
            begin, end = int(at[low]), int(at[high]) if high < len(at) else len(flat)
            mine = ids[starts[r]:starts[r + 1]]
            mark[mine] = 1
            both = np.add.reduceat(mark[flat[begin:end]], at[low:high] - begin, dtype=np.int64)
            mark[mine] = 0
            near = place[low:high][t.den * both >= t.num * (n + sizes[place[low:high]] - both)]
            for other in np.unique(labels[near[left[near]]]):
                left[members[other]] = False
                open_ += list(members[other])
                reached += list(members[other])
        result[reached] = labels[reached].min()
    out = np.empty_like(result)
    out[order] = result
    return out


def tile_links(tiles: DataFrame, t: Threshold) -> DataFrame:
    """(a, b): each label that `connect` changes within a tile (family, i, j), and the label it gets."""
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        labels = group["label"].to_numpy()
        values = group["items"].combine_chunks()
        flat, ends = values.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pa.compute.list_value_length(values).to_numpy())])
        found = connect([flat[ends[i]:ends[i + 1]] for i in range(len(labels))], labels, t)
        pairs = np.unique(np.stack([labels, found], axis=1)[labels != found], axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    return tiles.select("label", "items", "family", "i", "j").groupBy("family", "i", "j").applyInArrow(run, "a long, b long")


def _labelled(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with ``label``, the root of ``fp``: itself where it links with nothing."""
    named = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return nodes.join(named, F.col("fp") == F.col("_node"), "left").withColumn("label", F.coalesce("_root", "fp")).drop("_node", "_root")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    fresh = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))
    discard(roots)
    return fresh


def open_tiles(sets: DataFrame, groups: DataFrame, roots: DataFrame, tile: int) -> DataFrame:
    """Tiles of all that may still link in families beyond one task: sets that share a signature with another component.

    Blocks of a large component hold it alone, so that its blocks need not be compared with each other; smaller
    components are dealt whole.
    """
    mixed = _labelled(groups, roots).groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("sig")
    open_ = groups.join(mixed, "sig", "left_semi").select("fp").distinct()
    named = materialize(_labelled(sets.join(open_, "fp", "left_semi"), roots), "open")
    per = named.groupBy("family", "label").agg(F.count("*").alias("n"), F.max("blocks").alias("blocks"), F.sum(F.size("items").cast("long")).alias("values"))
    per = per.withColumn("own", F.when(2 * F.col("n") >= tile, F.greatest(F.ceil(F.col("n") / tile), F.ceil(F.col("values") / TILE_VALUES))))
    block = F.when(F.col("own").isNull(), F.concat(F.lit("s"), F.pmod(F.xxhash64("label"), "blocks"))).otherwise(
        F.concat(F.lit("c"), F.col("label"), F.lit("-"), F.pmod(F.xxhash64("fp"), "own")))
    placed = named.join(per.select("family", "label", "own"), ["family", "label"]).withColumn("block", block)
    blocks = materialize(placed.groupBy("family", "block").agg(F.max(F.when(F.col("own").isNotNull(), F.col("label"))).alias("alone")), "blocks")
    left, right = (blocks.select("family", F.col("block").alias(b), F.col("alone").alias(f"alone_{b}")) for b in ("i", "j"))
    pairs = left.join(right, "family").filter("i <= j AND NOT coalesce(alone_i = alone_j, false)").select("family", "i", "j")
    spread = pairs.select("family", F.col("i").alias("block"), "i", "j").union(pairs.filter("i < j").select("family", F.col("j").alias("block"), "i", "j"))
    return placed.join(spread, ["family", "block"])


def link_classes(docs: DataFrame, rows: DataFrame, t: Threshold, size: int = 5, tile: int = TILE) -> DataFrame:
    """(node, root) over fingerprints of classes that link with another class.

    Sets that meet in a kept signature, directly or by others, are a family, and every linking pair lies within one. A family
    of at most ``tile`` sets is compared by one task. Larger ones are dealt twice at random into blocks of that size, which
    joins most of what belongs together at a cost in proportion to their sets; then blocks are paired as far as their sets
    belong to different components and share a signature.
    """
    kept = materialize(kept_signatures(signature_rows(docs, t, size)), "signatures")
    groups = materialize(candidate_groups(kept), "groups")
    discard(kept)
    least = groups.groupBy("sig").agg(F.min("fp").alias("least"))
    family = components(groups.join(least, "sig").select(F.col("fp").alias("a"), F.col("least").alias("b")))
    members = _labelled(groups.select("fp").distinct(), family).withColumnRenamed("label", "family")
    sets = involved_sets(docs, members, rows, size).join(members, "fp")
    sets = materialize(sets, "sets")
    blocks = F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum(F.size("items").cast("long")) / TILE_VALUES)).cast("int")
    large = sets.groupBy("family").agg(blocks.alias("blocks")).filter("blocks > 1")
    dealt = attach(sets, large, ["family"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    def deal(part: DataFrame, salt: int) -> DataFrame:
        return part.withColumn("i", F.pmod(F.xxhash64("fp", F.lit(salt)), "blocks").cast("string")).withColumn("j", F.col("i"))

    roots = components(tile_links(deal(dealt.withColumn("label", F.col("fp")), 0), t))
    whole = dealt.filter("blocks > 1")
    if not large.isEmpty():
        roots = _joined(roots, tile_links(deal(_labelled(whole, roots), 1), t))
        roots = _joined(roots, tile_links(open_tiles(whole, groups, roots, tile), t))
    discard(groups, sets, family)
    return roots


def jaccard_join(docs: DataFrame, threshold: Threshold | None = None, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id reachable by links, its own included.

    A row without words is linked with nothing and is its own component. A null id takes no part in the smallest id, so
    such a row has its component's smallest id, or null. Repeated rows are equal sets. Columns besides doc_id and text
    are ignored. An empty table gives no rows.
    """
    t = threshold or Threshold()
    rows = materialize(classes(docs, size), "classes")
    roots = link_classes(docs, rows, t, size)
    own = rows.filter("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"))
    owners = own.join(roots, own["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = owners.join(owners.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.drop("th").join(named, "fp", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, threshold: Threshold | None = None) -> DataFrame:
    """One document of each component, all columns unchanged: the smallest id, then the smallest hash of the text.

    Rows without id come after those with one. Rows are told apart by id and text, so other texts of an id that goes
    stay. Of rows that repeat an id with the same text one stays; rows with neither id nor words all stay. Columns of any other
    name are kept as they are; an empty table gives an empty result.
    """
    t = threshold or Threshold()
    rows = materialize(classes(docs), "classes")
    roots = link_classes(docs, rows, t)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "th"))
    own = rows.filter("fp IS NOT NULL").groupBy("fp").agg(best.alias("own"))
    owners = own.join(roots, own["fp"] == roots["node"], "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    named = owners.join(owners.groupBy("root").agg(F.min("own").alias("best")), "root").select("fp", "best")
    chosen = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("th") == F.col("best.th"))
    gone = rows.join(named, "fp").filter(~chosen).select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct()
    kept = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["_gone_th"]), "left_anti")
    if rows.filter("doc_id IS NOT NULL OR fp IS NOT NULL").groupBy("doc_id", "th").count().filter("count > 1").isEmpty():
        return kept
    blank = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(f"[^{WHITE}]")
    return kept.filter(blank).unionByName(kept.filter(~blank).dropDuplicates(["doc_id", "text"]))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(root) FROM r WHERE r.node = d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id)
"""
