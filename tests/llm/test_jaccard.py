"""The join of near copies against all pairs, the signatures' guarantee, and the whole pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from flowsieve.llm import gbt, line_rules, packing, partenum, secrets
from flowsieve.llm.common import table

T = partenum.Threshold()


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted((str(d), len(s), str(least[top(i)] if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijklmnopqrst") + str(rng.randrange(30))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 5, 6, 8, 9, 12, 20, 60, 200]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(len(copy))
                copy[at:at + rng.choice([0, 1])] = [word()] if rng.random() < 0.7 else []
                copy = copy or [word()]
            rows.append(copy)
    chain = [word() for _ in range(100)]          # neighbours link, ends do not
    rows += [chain[i * 5:i * 5 + 60] for i in range(8)]
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, odd_rows, seed):
    rows = near_copies(seed) + [(None if r[0] is None else 10_000 + r[0], r[1]) for r in odd_rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((str(r[0]), r[1], str(r[2])) for r in partenum.jaccard_join(df).collect()) == brute(rows)


@pytest.mark.parametrize("tile", [5, 12])
def test_families_beyond_one_task(spark, tile):
    """The same rows and a family around the threshold, in tiles far smaller than the families."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = near_copies(3)
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            copy[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    classes = partenum.classes(df).persist()
    roots = {r["node"]: r["root"] for r in partenum.link_classes(df, classes, T, tile=tile).collect()}
    least = {}
    for r in classes.collect():
        top = roots.get(r["fp"], r["fp"])
        least[top] = min(least.get(top, r["doc_id"]), r["doc_id"])
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(least[roots.get(r["fp"], r["fp"])])) for r in classes.collect())
    assert got == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(2, 25), st.booleans())
def test_connect_is_union_find(seed, n, known):
    rng = np.random.default_rng(seed)
    pools = [rng.integers(0, 2**40, 24) for _ in range(3)]
    sets = [np.unique(np.concatenate([rng.choice(pools[i % 3], rng.integers(12, 25), replace=False), rng.integers(0, 2**40, rng.integers(0, 4))])) for i in range(n)]
    labels = np.arange(n) * 7 - 30
    if known and n > 3:
        labels[[1, 3]] = labels[2]          # told to belong together
    root = {i: i for i in range(n)}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if labels[i] == labels[j] or 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    want = [min(labels[j] for j in range(n) if top(j) == top(i)) for i in range(n)]
    assert partenum.connect(sets, labels, T).tolist() == want


def roots_by_union_find(links):
    root = {n: n for link in links for n in link}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in root if top(n) != n}


def chain_and_trees(seed):
    """A path or a tree of up to 8 nodes in random order."""
    rng = random.Random(seed)
    names = rng.sample(range(1, 100), rng.randrange(2, 9))
    return [(names[i], names[i - 1 if seed % 2 else rng.randrange(i)]) for i in range(1, len(names))]


@pytest.mark.parametrize("links", [[(1, 4), (4, 3), (3, 5), (5, 2)], [(4, 2), (2, 5), (5, 1), (1, 3)], *map(chain_and_trees, range(6))])
def test_components_join_all_that_is_linked(spark, links):
    """The first chain ends a round with edges to roots only, two of them from one node."""
    found = partenum.components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted(roots_by_union_find(links).items())


def test_empty_and_clashing_tables(odd, odd_rows, empty):
    assert partenum.jaccard_join(empty).count() == 0
    assert partenum.jaccard_join(odd).count() == len(odd_rows)
    kept = partenum.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, (1, 3, 4, None, 5, 6, 7, 9, 10)))


def test_one_of_each_tells_rows_by_id_and_text(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(1, one), (2, one), (2, two), (None, one), (None, one + " end"), (None, three), (None, three), (None, ""), (None, ""), (5, two), (5, two)]
    kept = partenum.one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, one), (2, two), (None, three), (None, ""), (None, "")], key=str)


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.integers(0, 12), st.integers(0, 12))
def test_linking_sets_share_a_kept_signature(seed, common, extra_a, extra_b):
    """With a frequency order against the pair: signatures they do not share come first."""
    rng = np.random.default_rng(seed)
    pool = np.unique(rng.integers(0, 2**63, common + extra_a + extra_b, dtype=np.uint64))
    a = np.sort(np.concatenate([pool[:common], pool[common:common + extra_a]]))
    b = np.sort(np.concatenate([pool[:common], pool[common + extra_a:]]))
    both = len(np.intersect1d(a, b))
    if 100 * both < 75 * (len(a) + len(b) - both) or len(a) == len(b) == both:
        return
    one, two = ({(g, s): (keep, filled) for g, filled, keep, sigs in partenum.signatures(x, T) for s in sigs.tolist()} for x in (a, b))
    shared = set(one) & set(two)
    def kept(mine, filled_of):
        out = set()
        for g in {g for g, _ in mine}:
            keep = next(v[0] for k, v in mine.items() if k[0] == g)
            sigs = sorted((k for k in mine if k[0] == g), key=lambda k: (k in shared, k))
            out |= set(sigs[:keep])
        return out
    assert kept(one, 0) & kept(two, 0)


def test_stages_one_by_one(spark, sf):
    docs = table(spark, sf, "documents")
    before = docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "jaccard_join", "secret_scan", "packing"]
    from flowsieve.session import materialize
    labels = table(spark, sf, "labels")
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, sf), f"test-{name}")
        ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
        if name == "quality_classifier":
            assert ids(out) == ids(gbt.quality_scores(docs, labels).filter("predicted = 1"))
        elif name == "quality_rules":
            assert ids(out) == ids(line_rules.quality_rules(docs).filter("kept"))
        elif name == "jaccard_join":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert ids(out) == sorted(int(d) for d, _, c in brute(rows) if d == c)
        elif name == "secret_scan":
            scanner = secrets.Scanner()
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert all(r["text"] == secrets.redact(texts[r["doc_id"]], scanner.scan(texts[r["doc_id"]])[1]) for r in out.collect())
        else:
            assert set(ids(out)) == set(ids(docs)) and out.columns == packing.digests(packing.pack_documents(docs)).columns
        if name != "packing":
            assert out.columns == docs.columns and 0.5 * before < out.count() <= before
        docs = out
    whole = lambda df: sorted(df.select("doc_id", "doc_tokens").distinct().collect())
    assert whole(docs) == whole(corpus_pipeline.run(spark, sf))
