"""Format-preserving pseudonyms for personal numbers and dates, in DataFrame functions only.

Numbers that pass their own check (card: Luhn; IBAN: modulo 97; social security, telephone and IPv4 numbers: their
ranges; dates: the calendar) go through a keyed Feistel network on their own domain: two halves, each round adding a
keyed hash of one half to the other, modulo the half's size. Check digits are computed anew, values outside the valid
range are walked on until they are inside, separators stay. The same value has the same pseudonym in every document, and
different values of a kind have different ones. Long numbers without a valid check digit are permuted as plain numbers;
the local part of mail addresses gets keyed letters and digits in place of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.line_rules import let

ROUNDS = 10
#: Days from 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = "1900-01-01", 73_049
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: The written forms that are looked for, in this order.
PATTERNS = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    r"(?<![0-9./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    r"(?<![0-9./-])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])",
    r"(?<![0-9./-])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9])",
    r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
)
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS)
KINDS = ("email", "iban", "date", "ssn", "phone", "ip", "card", "number")


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of pairs (a, b), a below size_a and b below size_b."""
    def step(s: Column, r: Column) -> Column:
        mixed = F.sha2(F.concat_ws("|", F.lit(key), tweak, r.cast("string"), s["b"].cast("string")), 256)
        added = s["a"] + F.conv(F.substring(mixed, 1, 13), 16, 10).cast("long")
        return F.struct(s["b"].alias("a"), F.pmod(added, F.when(r % 2 == 0, size_a).otherwise(size_b)).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permuted_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Another string of as many digits (2 to 36)."""
    def halves(n: Column) -> Column:
        u = (n / 2).cast("int")
        done = feistel(F.substr(digits, F.lit(1), u), F.substr(digits, u + 1), _ten(u), _ten(n - u), key, F.concat_ws(":", tweak, n.cast("string")))
        return let(done, lambda s: F.concat(F.lpad(s["a"].cast("string"), u, F.lit("0")), F.lpad(s["b"].cast("string"), n - u, F.lit("0"))))
    return let(F.length(digits), halves)


def walked(value: Column, once: Callable[[Column], Column], inside: Callable[[Column], Column], most: int) -> Column:
    """Cycle-walking: permute at least once, and on until the value lies inside."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), once(value), lambda x, _: F.when(inside(x), x).otherwise(once(x)))


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def placed(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    chars = F.transform(F.split(form, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substr(digits, F.length(only_digits(F.substr(form, F.lit(1), i + 1))), F.lit(1))).otherwise(c))
    return F.array_join(chars, "")


def luhn_digit(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    parts = F.transform(F.filter(F.split(F.reverse(payload), ""), lambda c: c != ""), lambda c, i: let(
        c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    total = F.aggregate(parts, F.lit(0), lambda s, x: s + x)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def mod97(iban: Column) -> Column:
    """ISO 7064 remainder of an IBAN without blanks, its first four characters moved to the end."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    def add(s: Column, c: Column) -> Column:
        letter = F.ascii(c) >= 65
        return F.pmod(s * F.when(letter, 100).otherwise(10) + F.ascii(c) - F.when(letter, 55).otherwise(48), F.lit(97))
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), add)


def parsed_date(text: Column) -> Column:
    """The date, day first unless only month first is one; null when it is none or outside the years served."""
    four = F.regexp_extract(text, "([0-9]{4})", 1)
    a, b = F.regexp_extract(text, "^([0-9]{1,2})[./]", 1), F.regexp_extract(text, "[./]([0-9]{1,2})[./]", 1)
    make = lambda d, m: F.try_to_date(F.concat_ws("-", four, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    found = F.when(text.rlike("^[0-9]{4}-"), F.try_to_date(text, "yyyy-MM-dd")).otherwise(F.coalesce(make(a, b), make(b, a)))
    return F.when((found >= F.lit(FIRST_DAY).cast("date")) & (found <= F.lit("2099-12-31").cast("date")), found)


def moved_date(text: Column, date: Column, key: str) -> Column:
    """Another date of 1900 .. 2099 in the same form."""
    def once(x: Column) -> Column:
        return let(feistel((x / 271).cast("long"), x % 271, F.lit(270).cast("long"), F.lit(271).cast("long"), key, F.lit("date")),
                   lambda s: s["a"] * 271 + s["b"])
    def written(d: Column) -> Column:
        a = F.regexp_extract(text, "^([0-9]{1,2})[./]", 1)
        day_first = F.try_to_date(F.concat_ws("-", F.substr(text, F.lit(-4)), F.lpad(F.regexp_extract(text, "[./]([0-9]{1,2})[./]", 1), 2, "0"),
                                              F.lpad(a, 2, "0")), "yyyy-MM-dd").isNotNull()
        wide = F.length(text) == 10
        part = lambda unit: F.when(wide, F.date_format(d, unit * 2)).otherwise(F.date_format(d, unit))
        mark = F.regexp_extract(text, "([./])", 1)
        split = F.when(day_first, F.concat(part("d"), mark, part("M"))).otherwise(F.concat(part("M"), mark, part("d")))
        return F.when(text.rlike("^[0-9]{4}-"), F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(split, mark, F.date_format(d, "yyyy")))
    number = F.date_diff(date, F.lit(FIRST_DAY).cast("date")).cast("long")
    return let(walked(number, once, lambda x: x < DAYS, 24), lambda x: let(F.date_add(F.lit(FIRST_DAY).cast("date"), x.cast("int")), written))


def kind_of(text: Column) -> Column:
    """The kind a match proves to be, null when its check fails."""
    plain = F.regexp_replace(text, "[ -]", "")
    whole = lambda p: text.rlike(f"^(?:{p})$")
    return (F.when(F.contains(text, F.lit("@")), "email")
            .when(text.rlike("^[A-Z]"), F.when(mod97(plain) == 1, "iban"))
            .when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}$"), F.when(parsed_date(text).isNotNull(), "date"))
            .when(whole(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(valid_ssn(plain), "ssn"))
            .when(text.rlike(rf"^{OCTET}(\.{OCTET}){{3}}$"), "ip")
            .when(whole(r"[0-9](?:[ -]?[0-9]){12,18}"), F.when(F.call_function("luhn_check", plain), "card").otherwise("number"))
            .otherwise("phone"))


def valid_ssn(digits: Column) -> Column:
    return digits.rlike("^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$")


def pseudonym(text: Column, kind: Column, key: str) -> Column:
    digits = only_digits(text)
    n = F.length(digits)
    card = let(permuted_digits(F.substr(digits, F.lit(1), n - 1), key, F.lit("card")), lambda p: F.concat(p, luhn_digit(p)))
    ssn = walked(digits, lambda x: permuted_digits(x, key, F.lit("ssn")), valid_ssn, 16)
    phone = F.concat(F.substr(digits, F.lit(1), n - 10), permuted_digits(F.substr(digits, n - 9), key, F.lit("phone")))
    octets = F.split(text, r"\.")
    ip = let(feistel(F.get(octets, 0).cast("long") * 256 + F.get(octets, 1).cast("long"), F.get(octets, 2).cast("long") * 256 + F.get(octets, 3).cast("long"),
                     F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, F.lit("ip")),
             lambda s: F.concat_ws(".", *(x.cast("int").cast("string") for h in ("a", "b") for x in (F.floor(s[h] / 256), s[h] % 256))))

    def iban() -> Column:
        body = F.substr(text, F.lit(5))
        inner = only_digits(body)
        changed = F.when(F.length(inner) >= 2, placed(body, permuted_digits(inner, key, F.concat(F.lit("iban"), F.substr(text, F.lit(1), F.lit(2)))))).otherwise(body)
        def checked(b: Column) -> Column:
            bare = F.concat(F.substr(text, F.lit(1), F.lit(2)), F.lit("00"), F.regexp_replace(b, " ", ""))
            return F.concat(F.substr(text, F.lit(1), F.lit(2)), F.lpad((98 - mod97(bare)).cast("string"), 2, "0"), b)
        return let(changed, checked)

    def mail() -> Column:
        local, domain = F.substring_index(text, "@", 1), F.substring_index(text, "@", -1)
        def spell(h: Column) -> Column:
            def char(c: Column, i: Column) -> Column:
                value = F.conv(F.substr(h, i % 63 + 1, F.lit(2)), 16, 10).cast("int")
                return (F.when(c.rlike("^[0-9]$"), (value % 10).cast("string")).when(c.rlike("^[a-z]$"), F.char(97 + value % 26))
                        .when(c.rlike("^[A-Z]$"), F.char(65 + value % 26)).otherwise(c))
            return F.concat(F.array_join(F.transform(F.split(local, ""), char), ""), F.lit("@"), domain)
        return let(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(text)), 256), spell)

    return (F.when(kind == "email", mail()).when(kind == "iban", iban()).when(kind == "date", moved_date(text, parsed_date(text), key))
            .when(kind == "ssn", placed(text, ssn)).when(kind == "phone", placed(text, phone)).when(kind == "ip", ip)
            .when(kind == "card", placed(text, card)).when(kind == "number", placed(text, permuted_digits(digits, key, F.lit("number"))))
            .otherwise(text))


def pseudonymised(docs: DataFrame, key: str = "public-demo-key", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and `found`: kind and pseudonym of each personal value in order of the text.

    One row for each input row, also for repeated rows. A null text stays null with nothing found, a null id stays null.
    Other columns are ignored. Mail addresses, dates outside 1900 .. 2099 and failing numbers: see the module. No row is
    shuffled.
    """
    text = F.col("text")

    def found(m: Column) -> Column:
        return let(kind_of(m), lambda k: F.struct(k.alias("kind"), pseudonym(m, k, key).alias("value")))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    named = rows.withColumn("all", F.when(text.isNotNull(), F.transform(matches, found)))
    joined = let(F.col("all"), lambda found_: F.array_join(F.flatten(F.zip_with(
        F.split(text, PATTERN), found_, lambda p, m: F.array(p, F.coalesce(m["value"], F.lit(""))))), ""))
    return named.select("doc_id", F.when(F.size("all") > 0, joined).otherwise(text).alias("text"),
                        F.coalesce(F.filter("all", lambda x: x["kind"].isNotNull()), F.array().cast("array<struct<kind:string,value:string>>")).alias("found"))
