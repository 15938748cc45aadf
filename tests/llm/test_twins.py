"""Plain twins: pseudonyms of whole texts, the classifier's statistics, the choice of a sequence; the pipeline on odd tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections import Counter

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from flowsieve.llm import gbt, packing, pii
from flowsieve.llm.common import table

# ---------------------------------------------------------------- pseudonyms


def feistel(a, b, size_a, size_b, key, tweak):
    for r in range(10):
        h = int(hashlib.sha256(f"{key}|{tweak}|{r}|{b}".encode()).hexdigest()[:13], 16)
        a, b = b, (a + h) % (size_a if r % 2 == 0 else size_b)
    return a, b


def permuted(digits, key, tweak):
    n = len(digits)
    u = n // 2
    a, b = feistel(int(digits[:u]), int(digits[u:]), 10 ** u, 10 ** (n - u), key, f"{tweak}:{n}")
    return f"{a:0{u}d}{b:0{n - u}d}"


def placed(form, digits):
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in form)


def luhn(payload):
    total = sum((d * 2 - 9 * (d > 4)) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(payload))))
    return str(-total % 10)


def mod97(iban):
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def parsed(text):
    def make(y, m, d):
        try:
            return dt.date(int(y), int(m), int(d))
        except ValueError:
            return None
    if re.match("[0-9]{4}-", text):
        found, day_first = make(*text.split("-")), True
    else:
        a, b, y = re.split("[./]", text)
        found = make(y, b, a)
        day_first = found is not None
        found = found or make(y, a, b)
    return (found, day_first) if found and 1900 <= found.year <= 2099 else (None, day_first)


def good_ssn(d):
    return re.fullmatch("(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}", d)


def plain_pseudonym(text, key):
    """(kind, pseudonym) of a match, or (None, text)."""
    digits = re.sub("[^0-9]", "", text)
    if "@" in text:
        local, domain = text.split("@")
        h = hashlib.sha256(f"{key}|email|{text.lower()}".encode()).hexdigest()
        out = ""
        for i, c in enumerate(local):
            v = int(h[i % 63:i % 63 + 2], 16)
            out += str(v % 10) if c in "0123456789" else chr(97 + v % 26) if "a" <= c <= "z" else chr(65 + v % 26) if "A" <= c <= "Z" else c
        return "email", f"{out}@{domain}"
    if text[0].isalpha():
        bare = text.replace(" ", "")
        if mod97(bare) != 1:
            return None, text
        body = text[4:]
        inner = re.sub("[^0-9]", "", body)
        body = placed(body, permuted(inner, key, f"iban{text[:2]}")) if len(inner) >= 2 else body
        return "iban", f"{text[:2]}{98 - mod97(text[:2] + '00' + body.replace(' ', '')):02d}{body}"
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}", text):
        date, day_first = parsed(text)
        if date is None:
            return None, text
        first, x = dt.date(1900, 1, 1), (date - dt.date(1900, 1, 1)).days
        while True:
            a, b = feistel(x // 271, x % 271, 270, 271, key, "date")
            x = a * 271 + b
            if x < 73_049:
                break
        new = first + dt.timedelta(days=x)
        if re.match("[0-9]{4}-", text):
            return "date", new.isoformat()
        mark = re.search("[./]", text)[0]
        part = (lambda v: f"{v:02d}") if len(text) == 10 else str
        return "date", mark.join([part(new.day), part(new.month)] if day_first else [part(new.month), part(new.day)]) + f"{mark}{new.year}"
    if re.fullmatch("[0-9]{3}-[0-9]{2}-[0-9]{4}", text):
        if not good_ssn(digits):
            return None, text
        while True:
            digits = permuted(digits, key, "ssn")
            if good_ssn(digits):
                return "ssn", placed(text, digits)
    if re.fullmatch(rf"{pii.OCTET}(\.{pii.OCTET}){{3}}", text):
        o = list(map(int, text.split(".")))
        a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        return "ip", f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if re.fullmatch("[0-9](?:[ -]?[0-9]){12,18}", text):
        if luhn(digits[:-1]) == digits[-1]:
            p = permuted(digits[:-1], key, "card")
            return "card", placed(text, p + luhn(p))
        return "number", placed(text, permuted(digits, key, "number"))
    return "phone", placed(text, digits[:-10] + permuted(digits[-10:], key, "phone"))


def plain_texts(text, key="public-demo-key"):
    found = []

    def change(m):
        kind, value = plain_pseudonym(m[0], key)
        if kind:
            found.append((kind, value))
        return value
    return regex.sub(pii.PATTERN, change, text), found


def test_pseudonyms_of_whole_texts_are_the_plain_ones(spark, sf):
    more = ["call (476) 555-6291 or +44 476 555 6291, ssn 123-45-6789 666-12-3456, born 29.02.1980, 2/29/1980, 07/08/1999 and 31/04/2001; GB82 WEST 1234 5698 7654 32",
            "4111 1111 1111 1111 4111111111111112 1.2.3.4 256.1.1.1 a.B+7@x-y.example.org DE89370400440532013000 DE88370400440532013000 2024-02-30 2023-12-31", "", "nothing"]
    docs = table(spark, sf, "documents").select("doc_id", "text").unionByName(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kinds = Counter()
    for r in pii.pseudonymised(docs).collect():
        text, found = plain_texts(texts[r["doc_id"]])
        assert (r["text"], [(f["kind"], f["value"]) for f in r["found"]]) == (text, found)
        kinds.update(k for k, _ in found)
    assert set(kinds) == set(pii.KINDS)


# ---------------------------------------------------------------- the classifier's statistics

def plain_statistics(text):
    n = len(text)
    if not n:
        return [0.0] * len(gbt.FEATURES)
    share = lambda test: sum(1 for b in text if test(b)) / n
    is_in = lambda chars: share(lambda b: chr(b) in chars and b < 128)
    words, raw = text.lower().split(), text.split()
    m, d = len(words), max(1, len(words))
    lines = [x.strip() for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    pairs = {(a, b) for a, b in zip(words, words[1:])}
    return {"log_bytes": math.log(1 + n), "log_words": math.log(1 + m), "mean_word": sum(len(w) for w in words) / d,
            "upper_share": share(lambda b: 65 <= b <= 90), "digit_share": share(lambda b: 48 <= b <= 57), "punct_share": is_in(".,;:?!'\"()-"),
            "symbol_share": is_in("#*$%&|<>{}[]\\^~=+_@`/"), "white_share": is_in(" \t\n\x0b\x0c\r"), "wide_share": share(lambda b: b > 127),
            "distinct_share": len(set(words)) / d, "log_lines": math.log(1 + len(lines)), "mean_line": n / k / 100,
            "dup_line_share": (len(lines) - len(set(lines))) / k, "end_mark_share": sum(x.endswith((b".", b"!", b"?")) for x in lines) / k,
            "capital_share": sum(w[:1].isupper() for w in raw) / d, "pipe_share": text.count(b"|") / n, "bang_share": text.count(b"!") / n,
            "top_word_share": max(Counter(words).values(), default=0) / d, "dup_pair_share": 1 - len(pairs) / max(1, m - 1) if m > 1 else 0.0,
            "stop_share": sum(w in gbt.STOPS for w in words) / d}


def test_statistics_are_the_plain_ones(spark, sf, odd_rows):
    texts = [r["text"] for r in table(spark, sf, "documents").collect()] + [t for _, t, *_ in odd_rows] + ["!!!", "|a|b|", "The the THE cat.\nthe cat.\n\nthe cat. "]
    for text in texts:
        raw = (text or "").encode()
        want = plain_statistics(raw)
        assert gbt.statistics(raw) == pytest.approx(list(want.values()) if want and isinstance(want, dict) else want)
        assert not isinstance(want, dict) or tuple(want) == gbt.FEATURES


# ---------------------------------------------------------------- the choice of a sequence

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=30), st.sampled_from([0.0, 0.01, 1.0]))
def test_each_piece_goes_to_the_cheapest_sequence_with_room(sizes, quadratic):
    limit, cost = 64, packing.Cost(1.0, quadratic)
    pieces = packing.pack(sizes, limit, cost)
    whole = sum(n // limit for n in sizes)
    assert all((n, offset) == (limit, 0) and start % limit == 0 for _, start, n, s, offset in pieces if s < whole)
    room = packing.capacities(sum(n % limit for n in sizes), limit)
    used, spent = [0] * len(room), [0.0] * len(room)
    waiting = sorted(((n % limit, doc, n - n % limit) for doc, n in enumerate(sizes) if n % limit), key=lambda r: (-r[0], r[1]))
    for doc, start, n, s, offset in pieces:
        if s < whole:
            continue
        left, at, begin = waiting[0]
        assert (doc, start) == (at, begin)                   # longest remainders first, one after the other
        with_room = [i for i in range(len(room)) if room[i] - used[i] >= left] or [i for i in range(len(room)) if room[i] > used[i]]
        best = min(with_room, key=lambda i: (spent[i], i))
        assert s - whole == best and n == min(left, room[best] - used[best]) and offset == used[best]
        used[best] += n
        spent[best] += cost.of(n)
        waiting[0] = (left - n, at, begin + n)
        if left == n:
            waiting.pop(0)
    assert not waiting and used == room


# ---------------------------------------------------------------- the pipeline on odd tables

@pytest.mark.parametrize("rows", ["none", "odd"])
def test_pipeline_on_empty_and_odd_tables(spark, sf, odd, empty, tmp_path, rows):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    given_ = table(spark, sf, "documents").limit(0) if rows == "none" else table(spark, sf, "documents").unionByName(
        odd.select(*cols).withColumn("doc_id", odd["doc_id"] + 10**6))
    given_.select(*cols).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, sf, "labels").write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    if rows == "odd":                                          # columns that operators use inside
        for name in ("score", "_host", "_gone_id", "_gone_th", "fp", "found", "kept", "label", "family"):
            docs = docs.withColumn(name, docs["lang"])
    from flowsieve.session import materialize
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), f"odd-{name}").select(*docs.columns)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert (docs.count() == 0) == (rows == "none") and docs.filter("text IS NULL OR text = ''").isEmpty()
