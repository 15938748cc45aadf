"""Quality trees, n-gram scores and line rules against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from harness import compare, duck

from flowsieve.llm import gbt, line_rules, ngram_trie
from flowsieve.llm import queries as corpus
from flowsieve.llm.common import crc_of

LABELS = "doc_id long, quality int, toxic int, score string"


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta the of and to river stone cloud paper".split()) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def labelled(spark):
    docs = [(i, prose(i) if i % 2 else "BUY!! NOW!! $$$ ### " * 20, "en", f"s{i % 3}", 0) for i in range(240)]
    docs += [(900, None, "en", None, 0), (901, "", "en", "s0", 0), (None, prose(5), "en", "s0", 0), (1, prose(1), "en", "s1", 0)]
    labels = [(i, i % 2, 0, "clash") for i in range(200)] + [(5, 0, 0, ""), (None, 1, 0, ""), (6, None, 0, ""), (7, 7, 0, ""), (5000, 1, 0, "")]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABELS)


def test_held_out_documents_are_told_apart(labelled):
    docs, labels = labelled
    rows = gbt.quality_scores(docs, labels, gbt.Fit(trees=20)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (crc_of(r["doc_id"]) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 240]
    assert len(held) > 40 and np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.95
    kept = gbt.keep_good(docs, labels, gbt.Fit(trees=20))
    assert kept.columns == docs.columns and {r["doc_id"] % 2 for r in kept.filter("doc_id < 240").collect()} == {1}


def test_held_out_labels_are_never_learnt(labelled, spark):
    from pyspark.sql import functions as F
    docs, labels = labelled
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda df: sorted((str(r["doc_id"]), r["score"]) for r in df.collect())
    assert key(gbt.quality_scores(docs, labels, gbt.Fit(trees=5))) == key(gbt.quality_scores(docs, turned, gbt.Fit(trees=5)))


def test_without_labels_or_documents(labelled, empty):
    docs, labels = labelled
    assert {r["score"] for r in gbt.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert gbt.quality_scores(empty, labels).count() == 0


def test_flat_trees_fit_what_cuts_can_express():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0.6)).astype(float)
    trees = gbt.fit_trees(x, y, trees=40, depth=3)
    assert ((trees.probability(x) >= 0.5) == y).mean() > 0.97
    for row in x[:20]:                       # one row walked by hand
        total = trees.base
        for f, c, v in zip(trees.feature, trees.cut, trees.value, strict=True):
            at = 0
            while f[at] >= 0 and 2 * at + 2 < len(f):
                at = 2 * at + 1 + (row[f[at]] > c[at])
            total += v[at]
        assert abs(1 / (1 + math.exp(-total)) - trees.probability(row[None])[0]) < 1e-12


def test_accuracy_on_the_given_table(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    scored = gbt.quality_scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.85


def test_line_rules_on_odd_rows(spark, tmp_path, odd, empty):
    line = "this very common notice stands in many pages of this host"
    rows = [(100 + i, f"{line}\n{line} {i % 7}\n" + ("own words " * 1 if i % 2 else prose(i) + "\n" + prose(i + 999)), "en", "h1", 0) for i in range(60)]
    rows += [(300, "a b c d e\na b c d e\n\nA  b c d 7\na b c d e f g", "en", None, 0), (301, " ".join(str(i % 5) for i in range(40)), "en", "h2", 0)]
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").unionByName(odd.select(*cols))
    table.toPandas().astype({"doc_id": "Int64"}).to_parquet(tmp_path / "documents.parquet")
    got = line_rules.quality_rules(table)
    assert compare(got, duck(str(tmp_path)), line_rules.ORACLE) == []
    verdict = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert not verdict[101] and verdict[100] and not verdict[301]
    kept = line_rules.keep_sound(odd)
    assert kept.columns == odd.columns and line_rules.quality_rules(empty).count() == 0


def test_limits_of_frequent_lines(spark, tmp_path):
    """Null and empty texts of a host are one text; a line in many texts is frequent however large its host is."""
    letters = str.maketrans("0123456789", "abcdefghij")                    # digits of a line all count as 0
    own = lambda i: " ".join(str((i * 7919 + j * 104729) % 99991).translate(letters) for j in range(12))
    notice = "one notice of twelve words that fills more than half of it"
    rows = [(i, f"{notice}\n{own(i) if i % 2 else 'five words of its own'}", "edge", 0) for i in range(21)]
    rows += [(100 + i, own(i), "edge", 0) for i in range(2099 - 21)] + [(9000, None, "edge", 0), (9001, "", "edge", 0)]        # 2,100 texts: 21 are not above 1 %
    rows += [(20_000 + i, f"{notice}\nfive words of its own {own(i)[:9]}" if i < 25 else own(i), "mid", 0) for i in range(3000)]          # 25 of 3,000: below 1 %, rare
    rows += [(40_000 + i, f"{notice}\nfive words of its own {own(i)[:9]}" if i < 201 else own(i), "big", 0) for i in range(21_000)]      # 201 of 21,000: below 1 %, but many
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    table.toPandas().to_parquet(tmp_path / "documents.parquet")
    got = line_rules.quality_rules(table)
    assert compare(got, duck(str(tmp_path)), line_rules.ORACLE) == []
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert kept[0] and kept[20_000] and not kept[40_000] and kept[40_500] and not kept[9000]
    empty = line_rules.quality_rules(table.filter("doc_id < 25 OR doc_id >= 9000 AND doc_id < 9002"), with_text=True)
    assert {r["doc_id"]: r["text"] for r in empty.collect() if r["doc_id"] > 8000} == {9000: None, 9001: ""}
    assert line_rules.keep_sound(table.limit(0)).count() == 0


def plain_removal(rows, share=0.01, least=20):
    """Texts of (text, host) rows without frequent lines, and whether they lose more than half of their words."""
    def norm(line):
        return re.sub("[0-9]", "0", " ".join(re.findall(r"[^\x20\x09-\x0D]+", line)).lower())
    hosts = {}
    for text, host in rows:
        hosts.setdefault(host, set()).add(text)
    often = {}
    for host, texts in hosts.items():
        n = Counter(line for t in texts for line in {norm(x) for x in t.split("\n")} if line)
        often[host] = {line for line, c in n.items() if c > least and c > share * len(texts)}
    out = []
    for text, host in rows:
        kept = [x for x in text.split("\n") if norm(x) not in often[host]]
        out.append(("\n".join(kept), 2 * len("\n".join(kept).split()) < len(text.split())))
    return out


def test_frequent_lines_are_taken_out_of_the_text(spark):
    notice = "all rights  reserved by page 7"
    rows = [(i, f"{notice}\n\n{prose(i)}\nALL rights reserved by page {i % 10} \n" + (prose(i + 500) + "\n" if i % 3 else ""), f"h{i % 2}", 1, "clash") for i in range(60)]
    rows += [(100 + i, f"{notice}\n" * 3 + f"ten short words of its own stand here number {i} x", "h0", 1, "clash") for i in range(3)]
    rows += [(200, f"{notice}\n{prose(77)}", "rare", 1, "clash"), (201, prose(78), None, 1, "clash"), (0, rows[0][1], "h0", 1, "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, _host string").repartition(3)
    want = plain_removal([(r[1], r[2]) for r in rows])
    full = line_rules.quality_rules(df, with_text=True)
    assert sorted((r["doc_id"], r["text"]) for r in full.collect()) == sorted((r[0], t) for r, (t, _) in zip(rows, want, strict=True))
    kept = line_rules.keep_sound(df)
    failed = {r["doc_id"] for r in full.collect() if r["base_failed"]}
    expect = [(r[0], t, r[2], len(t), "clash") for r, (t, gone) in zip(rows, want, strict=True) if not gone and r[0] not in failed]
    assert kept.schema == df.schema and sorted(map(tuple, kept.collect()), key=str) == sorted(expect, key=str)
    assert any(gone for _, gone in want) and len(expect) > 20 and not any("reserved" in e[1] for e in expect if e[2] in ("h0", "h1"))


@pytest.mark.parametrize("name", sorted(corpus.ORACLE))
def test_queries_match_sql(spark, sf, name):
    assert compare(corpus.QUERIES[name](spark, sf), duck(sf), corpus.ORACLE[name]) == []


def direct_scores(docs, rule, head):
    """The model's formula, token by token, from plain counters."""
    held = lambda d: crc_of(d) % 5 == 1
    words = [(d, (t or "").encode().lower().split() + ["</s>"]) for d, t in docs]
    uni, two, three, texts = Counter(), Counter(), Counter(), 0
    for d, ws in words:
        if not held(d):
            texts += 1
            row = ["<s>", "<s>", *ws]
            uni.update(ws)
            for i in range(2, len(row)):
                two[tuple(row[i - 1:i + 1])] += 1
                three[tuple(row[i - 2:i + 1])] += 1
    two["<s>", "<s>"], total, seen = texts, sum(uni.values()), len(uni)
    g = max(sum(c == 1 for c in uni.values()), 0.5) / total
    of = lambda w: texts if w == "<s>" else uni[w]
    weight = lambda w: (rule.head_mass * max(of(w), 1), rule.head_weight) if w in head(uni) or w == "<s>" else (rule.tail_mass, rule.tail_weight)
    out = []
    for d, ws in words:
        row, score = ["<s>", "<s>", *ws], 0.0
        for u, v, w in zip(row, row[1:], row[2:]):
            m, f = weight(v)
            q = (1 - g) * uni[w] / total if uni[w] else g
            score += math.log10((three[u, v, w] + f * (two[v, w] + m * q)) / (two[u, v] + f * (of(v) + m)))
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (seen + 1))) for w in ws)
        out.append((str(d), held(d), len(ws), sum(uni[w] > 0 for w in ws), total, base, score))
    return sorted(out)


def test_trie_scores_equal_the_formula(spark, odd, odd_rows, empty, monkeypatch):
    docs = [(r[0], r[1]) for r in odd_rows] + [(50 + i, prose(i, 30)) for i in range(60)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((str(r[0]), *r[1:]) for r in ngram_trie.lm_scores(table, shard_tokens=400).collect())
    want = direct_scores(docs, ngram_trie.Smoothing(), lambda uni: uni)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 2e-4 * a[2]
    assert ngram_trie.lm_scores(odd).count() == len(odd_rows) and ngram_trie.lm_scores(empty).count() == 0


def test_probabilities_sum_to_one():
    """Over all words and the unknown one, for a frequent and for a rare context."""
    rng = np.random.default_rng(2)
    n = 3000
    last = rng.integers(0, 40, n).astype(np.uint64)
    before, first = np.roll(last, 1), np.roll(last, 2)
    counts = np.bincount(last.astype(int), minlength=40)
    head = np.arange(40, dtype=np.uint64)
    corpus_ = ngram_trie.Corpus(n, 40, 7, 1, head, counts)
    rule = ngram_trie.Smoothing()
    for u, v in ((3, 4), (int(first[10]), int(before[10]))):
        ask = np.append(head, np.uint64(1 << 62))
        rows = (np.concatenate([last, ask]), np.concatenate([before, np.full(41, v, np.uint64)]), np.concatenate([first, np.full(41, u, np.uint64)]))
        learnt = np.concatenate([np.ones(n, bool), np.zeros(41, bool)])
        _, _, part = ngram_trie.shard_scores(*rows, learnt, corpus_, rule)
        # numerators: ``part`` minus the word's own context term, which the next token's denominator is
        m, f = ngram_trie.context_weights(np.array([v], np.uint64), corpus_, rule)
        pair = ((first == u) & (before == v)).sum()
        own_m, own_f = ngram_trie.context_weights(ask, corpus_, rule)
        c = np.append(counts, 0)
        bigram = np.array([((before == v) & (last == w)).sum() for w in ask])
        own = np.log10(bigram + own_f * (c + own_m))
        end = ask == np.searchsorted(head, ngram_trie.END)
        top = 10 ** (part[n:] + np.where(end, 0, own))
        assert abs(top.sum() / (pair + f[0] * (counts[v] + m[0])) - 1) < 2e-3


def test_elias_fano_keeps_values_and_finds_successors():
    rng = np.random.default_rng(4)
    assert zlib.crc32(b"1") == crc_of(1)
    for n, top in ((0, 1), (1, 1), (1, 2**62), (7, 8), (50, 3), (1000, 10**12), (500, 2**62), (3000, 20_000)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        values[n // 2:] += np.uint64(top // 2)                            # a gap of empty buckets
        ef = ngram_trie.EliasFano.of(values)
        assert (ef.get(np.arange(n)) == values).all()
        keys = np.concatenate([values, values + np.uint64(1), values - np.minimum(values, 1).astype(np.uint64),
                               rng.integers(0, 2 * top, 300).astype(np.uint64), np.array([0, 2**63], np.uint64)])
        for start, end in ((None, None), (rng.integers(0, n + 1, len(keys)), None), (rng.integers(0, n // 2 + 1, len(keys)), rng.integers(n // 2, n + 1, len(keys)))):
            at, hit = ef.successor(keys, start, end)
            for i, key in enumerate(keys):
                a, b = (0 if start is None else start[i]), (n if end is None else end[i])
                want = a + int(np.searchsorted(values[a:b], key))
                assert (at[i], hit[i]) == (want, want < b and values[want] == key)


def test_selects_and_ranks_of_bits():
    rng = np.random.default_rng(5)
    for size, share in ((1, 1.0), (64, 0.5), (1000, 0.02), (1000, 0.98), (5000, 0.5)):
        flags = rng.random(size) < share
        bits = ngram_trie.Bits.of(np.flatnonzero(flags), size)
        assert (bits.select(np.arange(flags.sum())) == np.flatnonzero(flags)).all()
        assert (bits.select_zero(np.arange((~flags).sum())) == np.flatnonzero(~flags)).all()
        before, there = bits.rank(np.arange(size))
        assert (before == np.cumsum(flags) - flags).all() and (there == flags).all()


def test_nodes_are_found_below_their_context_only():
    """Positions in the compact levels are those of a dictionary, for known and unknown n-grams, short ids and hashes."""
    rng = np.random.default_rng(6)
    names = np.concatenate([np.arange(0, 40), (rng.integers(0, 2**61, 30) | 1 << 62)]).astype(np.uint64)
    grams = np.unique(rng.choice(names[::2], (4000, 3)), axis=0)          # sorted by last, before, first
    ask = np.unique(np.concatenate([grams[::3], rng.choice(names, (3000, 3))]), axis=0)
    corpus_ = ngram_trie.Corpus(len(grams), 60, 1, 1, np.arange(ngram_trie.SHORT, dtype=np.uint64), np.ones(ngram_trie.SHORT, np.int64))
    trie, _ = ngram_trie.build_trie(*grams.T, corpus_, ngram_trie.Smoothing())
    for depth, found in enumerate(trie.find(*ask.T), 1):
        place = {tuple(g): i for i, g in enumerate(np.unique(grams[:, :depth], axis=0).tolist())}
        assert found.tolist() == [place.get(tuple(g), -1) for g in ask[:, :depth].tolist()]
