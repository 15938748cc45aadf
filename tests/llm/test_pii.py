"""Pseudonyms keep their format and checks, link equal values, and are one-to-one."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from flowsieve.llm import pii

CASES = {
    "card": ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004"], "phone": ["+1 (476) 555-6291", "476-555-6291"],
    "ssn": ["123-45-6789"], "ip": ["248.167.124.71", "1.2.3.4"], "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["1980-02-29", "29/02/1980", "2/29/1980", "29.02.1980", "07/08/1999"], "number": ["9541066823582200"],
    "email": ["del.47@mail4.example.com"]}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban_ok(text):
    text = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, f"a {v}, b {v}; {kind}") for i, (kind, v) in enumerate((k, v) for k, vs in CASES.items() for v in vs)]
    out = {r["doc_id"]: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return {v: out[i] for i, (_, v) in enumerate((k, v) for k, vs in CASES.items() for v in vs)}


def test_formats_checks_and_links(found):
    shape = lambda v: re.sub("[a-z]", "a", re.sub("[0-9]", "9", v))
    for kind, values in CASES.items():
        for v in values:
            row = found[v]
            assert [f["kind"] for f in row["found"]] == [kind, kind], (kind, v, row)
            new = row["found"][0]["value"]
            assert new == row["found"][1]["value"] != v and row["text"] == f"a {new}, b {new}; {kind}" and v not in row["text"]
            if kind not in ("ip", "date"):
                assert shape(new) == shape(v), (v, new)
    digits = lambda v: re.sub("[^0-9]", "", v)
    value = lambda v: found[v]["found"][0]["value"]
    assert all(luhn(digits(value(v))) for v in CASES["card"]) and all(iban_ok(value(v)) for v in CASES["iban"])
    assert digits(value("4111 1111 1111 1111")) == value("4111111111111111")
    assert digits(value("+1 (476) 555-6291"))[1:] == digits(value("476-555-6291")) and value("+1 (476) 555-6291").startswith("+1 ")
    assert value("1980-02-29").split("-") == [value("29/02/1980").split("/")[i] for i in (2, 1, 0)] == [value("29.02.1980").split(".")[i] for i in (2, 1, 0)]
    assert re.fullmatch("(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}", value("123-45-6789"))
    assert all(0 <= int(x) < 256 for x in value("248.167.124.71").split("."))


def test_failing_numbers_stay(spark, odd, odd_rows, empty):
    text = "31/02/2020 1850-01-01 000-12-3456 999.1.1.1 DE00370400440532013000 12 3.14 2024-13-01 v1.2.3.4.5 abc4111111111111111"
    assert [r["text"] for r in pii.pseudonymised(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()] == [text]
    same = pii.pseudonymised(odd)
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in same.collect()))) == sorted(str((i, t)) for i, t, *_ in odd_rows)
    assert pii.pseudonymised(empty).count() == 0


def test_digits_and_dates_are_permuted_one_to_one(spark):
    three = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    new = three.select(pii.permuted_digits(F.col("d"), "k", F.lit("t")).alias("n"), pii.permuted_digits(F.col("d"), "other", F.lit("t")).alias("o"))
    rows = new.collect()
    assert sorted(r["n"] for r in rows) == sorted(r["o"] for r in rows) == [f"{i:03d}" for i in range(1000)]
    assert sum(r["n"] == r["o"] for r in rows) < 20
    days = spark.range(pii.DAYS).select(F.date_format(F.date_add(F.lit(pii.FIRST_DAY).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("t"))
    moved = days.select(pii.moved_date(F.col("t"), F.col("t").cast("date"), "k").alias("m"))
    assert moved.distinct().count() == pii.DAYS and moved.filter("m < '1900-01-01' OR m > '2099-12-31'").count() == 0


def test_plan_has_no_python(spark, odd):
    plan = pii.pseudonymised(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan
