"""Secret scans: fixed patterns plus Shannon entropy over sliding windows of candidate strings.

A candidate is a maximal run of one character class. A window of fixed width slides over it one character at a time;
its entropy follows from incremental counts (one character leaves, one enters). Windows at or above the class's
threshold, with enough changes between kinds of characters, are joined into spans. Allow-listed candidates (words, numbers, names with few digits, identifiers, given
strings) raise no span. Pattern spans always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import ready, rows_of

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ORDER = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}


@dataclass(frozen=True)
class CharClass:
    """Runs matched by ``run`` are candidates; windows of ``width`` characters reach ``bits`` of entropy to count.

    They also change at least ``turns`` times between lower case, upper case, digits and other characters.
    """

    name: str
    run: str
    width: int
    bits: float
    turns: int = 0


#: Random strings of the class pass, words and numbers do not: log2 of the window's width is the most it can have. Short
#: windows reach what 99 of 100 random ones do (of base32 for upper case); as words do so, too, names are told by their turns.
CLASSES = (CharClass("base64", r"[A-Za-z0-9+/_=-]{24,}", 24, 4.0), CharClass("hex", r"[0-9A-Fa-f]{32,}", 32, 3.2),
           CharClass("lower", r"[a-z0-9]{16,}", 16, 3.15, 3), CharClass("upper", r"[A-Z0-9]{16,}", 16, 3.07, 3),
           CharClass("short hex", r"[0-9A-Fa-f]{16,}", 16, 2.65, 3), CharClass("mixed", r"[A-Za-z0-9+/_=-]{16,}", 16, 3.37, 7))
#: Candidates matching one of these in full are known to be harmless.
ALLOW = (r"[A-Za-z_=/+-]*", r"[0-9_=/+.-]*", r"[A-Z]?[a-z][A-Za-z]*(?:[-_/=+][A-Za-z]+)*[-_=/+]?[0-9]{0,6}",
         r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}")


@dataclass
class Scanner:
    classes: tuple[CharClass, ...] = CLASSES
    allow: tuple[str, ...] = ALLOW
    allow_strings: frozenset[str] = frozenset()
    _runs: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self._runs = [(c, re.compile(c.run), _terms(c.width)) for c in self.classes]
        self._allowed = re.compile("|".join(f"(?:{p})" for p in self.allow)) if self.allow else None

    def base(self, text: str) -> list[tuple[str, int, int]]:
        spans = []
        low = text.lower()
        if any(word in low for word in KEYWORDS):
            spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
        if "AKIA" in text:
            spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))

    def suppressed(self, candidate: str) -> bool:
        return candidate in self.allow_strings or bool(self._allowed and self._allowed.fullmatch(candidate))

    def entropy(self, text: str) -> list[tuple[str, int, int]]:
        found, open_, harmless = [], [], []
        for kind, run, terms in self._runs:
            for m in run.finditer(text):
                if self.suppressed(m.group()):
                    harmless.append(m.span())
                else:
                    open_.append((m, kind, terms))
        harmless.sort(key=lambda s: (s[0], -s[1]))
        reach = list(accumulate((end for _, end in harmless), max))
        for m, kind, terms in open_:
            at = bisect_right(harmless, m.start(), key=lambda s: s[0])
            if not (at and reach[at - 1] >= m.end()):      # a part of an allowed candidate is allowed
                found += [(m.start() + a, m.start() + b) for a, b in high_windows(m.group(), kind.width, kind.bits, terms, kind.turns)]
        joined: list[list[int]] = []
        for start, end in sorted(found):
            if joined and start <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], end)
            else:
                joined.append([start, end])
        return [("entropy", a, b) for a, b in joined]

    def scan(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Pattern spans, and all spans in order of start, then kind."""
        base = self.base(text)
        return base, sorted(base + self.entropy(text), key=lambda s: (s[1], ORDER[s[0]], s[2]))


def _terms(width: int) -> list[float]:
    """c * log2(c) for the counts a window can hold."""
    return [0.0] + [c * math.log2(c) for c in range(1, width + 1)]


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def high_windows(text: str, width: int, bits: float, terms: list[float] | None = None, turns: int = 0) -> list[tuple[int, int]]:
    """Maximal spans covered by overlapping windows of ``width`` characters with at least ``bits`` of entropy.

    Windows with fewer than ``turns`` changes between kinds of characters are passed over.
    Entropy is log2(width) - sum(c log2 c) / width; the sum changes by two counts when the window moves.
    """
    terms = terms or _terms(width)
    if len(text) < width:
        return []
    counts: dict[str, int] = {}
    total = 0.0
    most = (math.log2(width) - bits) * width + 1e-9
    changes = [0, *accumulate(_kind(a) != _kind(b) for a, b in pairwise(text))] if turns else []
    spans: list[tuple[int, int]] = []
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += terms[n + 1] - terms[n] if n < width else 0.0
        if i >= width:
            gone = text[i - width]
            n = counts[gone]
            counts[gone] = n - 1
            total += terms[n - 1] - terms[n] if n <= width else 0.0
        if i >= width - 1 and total <= most:
            start = i - width + 1
            if turns and changes[i] - changes[start] < turns:
                continue
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """Every stretch covered by spans becomes one mark."""
    out, at = [], 0
    for start, end in ((s, e) for _, s, e in sorted(spans, key=lambda s: s[1:])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text",
                 with_text: bool = False) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans (and the redacted text).

    One row for each input row, also for repeated rows. A null text counts as empty; a null id stays null. Spans are
    ``kind:start:end`` in code points, end exclusive, by start and then kind. Columns beyond id and text are ignored.
    Nothing is shuffled.
    """
    scanner = scanner or Scanner()
    rows = ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = ("doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string"
              + (", text string" if with_text else ""))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            out: list[list] = [[] for _ in range(8 if with_text else 7)]
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                base, spans = scanner.scan(text or "")
                kinds = [s[0] for s in spans]
                row = [doc, *(kinds.count(k) for k in ORDER), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)]
                if with_text:
                    row.append(None if text is None else redact(text, spans))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            kinds_ = [pa.int64()] * 5 + [pa.string()] * (3 if with_text else 2)
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds_, strict=True)], names=names)

    return rows.mapInArrow(scan, schema)


def redact_documents(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """The documents with every secret replaced by a mark; all columns stay, ``n_chars`` follows the new text in its own type.

    A null text stays null, an empty one empty; repeated rows are scanned one by one. An empty table gives an empty result.
    """
    scanner = scanner or Scanner()
    ready(docs)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redact(t, scanner.scan(t)[1]) for t in batch["text"].to_pylist()]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
