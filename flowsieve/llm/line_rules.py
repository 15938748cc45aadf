"""Quality rules with cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, digits to 0, white space to single blanks) and hashed. Per host (``source``) the
distinct documents of each line are counted; exact copies of a text are one document, and so are null and empty texts. Lines
in more documents than the limit are taken out of the text, and a document that loses more than ``max_lost`` of its words is rejected. A few
per-document rules come first: too few words, too many words in repeated five-word windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsieve.llm.common import WHITE
from flowsieve.session import materialize

#: A line is frequent in more than ``LEAST`` distinct documents of its host, if these are more than ``SHARE`` of them or more than ``MOST``.
SHARE, LEAST, MOST, MAX_LOST = 0.01, 20, 200, 0.5


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it as a variable inside ``body``."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"[^{WHITE}]+"), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words covered by five-word windows that occur twice or more in the list."""
    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def repeated(all_: Column) -> Column:
            last = F.size(all_) - 1
            near = F.filter(all_, lambda e, j: ((j > 0) & (F.get(all_, j - 1)["h"] == e["h"]))
                            | ((j < last) & (F.get(all_, j + 1)["h"] == e["h"])))
            return F.array_sort(F.transform(near, lambda e: e["i"]))
        def length(at: Column) -> Column:
            gaps = F.transform(at, lambda p, j: F.least(F.lit(5), F.coalesce(F.get(at, j + 1) - p, F.lit(5))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)
        return let(let(ordered, repeated), length)

    def count(ws: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(ws) - 5),
                              lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2), F.get(ws, i + 3), F.get(ws, i + 4)))
        some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))
        return F.when(F.size(ws) > 5, some).otherwise(F.lit(0).cast("long"))

    return let(words, count)


def base_rules(docs: DataFrame) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; null text: none."""
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{WHITE}]"))
    measured = let(words_of(text), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), repeat_words(ws).alias("n_repeat_words")))
    dup = let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))
    return docs.select(
        "*", measured.alias("_m"), F.length(F.regexp_replace(text, f"[{WHITE}]+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"), dup.alias("n_dup_lines"),
    ).select("*", "_m.n_words", "_m.n_repeat_words").drop("_m").withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _lines(docs: DataFrame) -> DataFrame:
    """One row for each line with words of each distinct text of a host: text hash, position, line hash, words."""
    def digest(line: Column) -> Column:
        return let(words_of(line), lambda ws: F.struct(
            F.size(ws).cast("long").alias("w"),
            F.xxhash64(F.regexp_replace(F.lower(F.array_join(ws, " ")), "[0-9]", "0")).alias("h")))

    lines = F.transform(F.split("_text", "\n"), digest)
    return (docs.select("_host", F.xxhash64("_text").alias("_d"), F.posexplode(lines).alias("_p", "_l"))
            .filter(F.col("_l.w") > 0).groupBy("_host", "_d", "_p").agg(F.max("_l.h").alias("_h"), F.max("_l.w").alias("_w")))


def touched_texts(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, max_lost: float = MAX_LOST) -> DataFrame:
    """_host, _d, _cut and _gone of texts with frequent lines: their positions, and whether they hold more than ``max_lost`` of the words.

    The documents of a line are counted in two steps, so that a line of a third of all documents is summed where it
    lies; the join with the few frequent lines is left to adaptive execution, which splits or broadcasts it.
    """
    hosts = docs.groupBy("_host", F.xxhash64("_text").alias("_d")).agg(F.count("*").alias("_c")).groupBy("_host").agg(F.count("*").alias("_docs"))
    lines = materialize(_lines(docs), "lines")
    counts = lines.groupBy("_host", "_h", "_d").agg(F.count("*").alias("_c")).groupBy("_host", "_h").agg(F.count("*").alias("_n"))
    frequent = counts.filter(F.col("_n") > least).join(hosts, "_host").filter((F.col("_n") > share * F.col("_docs")) | (F.col("_n") > most)).select("_host", "_h", F.lit(True).alias("_often"))
    touched = lines.join(frequent, ["_host", "_h"]).groupBy("_host", "_d").agg(F.sum("_w").alias("_lost"), F.collect_list("_p").alias("_cut"))
    whole = lines.groupBy("_host", "_d").agg(F.sum("_w").alias("_words"))
    return touched.join(whole, ["_host", "_d"]).select("_host", "_d", "_cut", (F.col("_lost") > max_lost * F.col("_words")).alias("_gone"))


def depleted_texts(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, max_lost: float = MAX_LOST) -> DataFrame:
    """(_host, _d) of texts of which frequent lines hold more than ``max_lost`` of the words."""
    return touched_texts(docs, share, least, most, max_lost).filter("_gone").select("_host", "_d")


def without_lines(text: Column, cut: Column) -> Column:
    """The text without the lines at the positions ``cut``; as it is where that is null."""
    def rest(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
        return F.array_join(F.transform(places, lambda p: F.get(lines, p)), "\n")
    return F.when(cut.isNull(), text).otherwise(let(F.split(text, "\n"), rest))


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"_text": F.coalesce(F.col("text").cast("string"), F.lit("")), "_host": F.coalesce(F.col("source").cast("string"), F.lit(""))})


def quality_rules(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, max_lost: float = MAX_LOST, with_text: bool = False) -> DataFrame:
    """doc_id, the counts of `base_rules`, base_failed and kept (and the text without frequent lines), one row for each input row.

    Null text: no words, so base_failed. Null source: the host "". Repeated rows get equal verdicts. Counts and base
    rules are those of the whole text. Columns besides doc_id, text and source are ignored. An empty table gives an
    empty result.
    """
    rows = _prepared(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    if with_text:
        touched = touched_texts(rows, share, least, most, max_lost)
        measured = base_rules(rows).withColumn("_d", F.xxhash64("_text"))
        return (measured.join(touched, ["_host", "_d"], "left")
                .withColumn("kept", ~F.col("base_failed") & ~F.coalesce("_gone", F.lit(False)))
                .select(*names, F.when(F.col("text").isNotNull(), without_lines(F.col("_text"), F.col("_cut"))).alias("text")))
    gone = depleted_texts(rows, share, least, most, max_lost).withColumn("_gone", F.lit(True))
    measured = base_rules(rows).withColumn("_d", F.xxhash64("_text")).drop("text", "_text")
    return (measured.join(gone, ["_host", "_d"], "left")
            .withColumn("kept", ~F.col("base_failed") & F.col("_gone").isNull())
            .select(*names))


def keep_sound(docs: DataFrame, share: float = SHARE, least: int = LEAST, most: int = MOST, max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that pass base rules and are not depleted, without their frequent lines.

    All columns stay, ``n_chars`` follows the new text in its own type. Null and empty texts have no words and go; a null source is
    the host "". Repeated rows stay or go together. An empty table gives an empty result; columns of any other name are kept.
    """
    rows = _prepared(docs.select(F.struct("*").alias("_row"), "text", "source"))
    touched = touched_texts(rows, share, least, most, max_lost)
    sound = base_rules(rows).filter(~F.col("base_failed")).withColumn("_d", F.xxhash64("_text")).select("_row", "_text", "_host", "_d")
    kept = (sound.join(touched, ["_host", "_d"], "left").filter(~F.coalesce("_gone", F.lit(False)))
            .select("_row", without_lines(F.col("_text"), F.col("_cut")).alias("_text")))
    new = {"text": F.col("_text").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
             row_number() OVER () AS r FROM d),
t AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
n AS (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five
      FROM t WINDOW o AS (PARTITION BY r ORDER BY i)),
m AS (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM n WHERE five IS NOT NULL),
p AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM m, (SELECT unnest(range(5)) AS k) WHERE c > 1 GROUP BY r),
b AS (SELECT w.r, doc_id, host, text, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars,
             len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN p ON w.r = p.r),
u AS (SELECT DISTINCT host, text FROM d),
l AS (SELECT host, text, regexp_extract_all(unnest(string_split(text, chr(10))), '[^\x20\x09-\x0D]+') AS lw FROM u),
h AS (SELECT host, text, len(lw) AS n, regexp_replace(lower(array_to_string(lw, ' ')), '[0-9]', '0', 'g') AS line FROM l WHERE len(lw) > 0),
f AS (SELECT host, line FROM h GROUP BY host, line
      HAVING count(DISTINCT text) > {least} AND (count(DISTINCT text) > {share} * (SELECT count(*) FROM u WHERE u.host = h.host) OR count(DISTINCT text) > {most})),
x AS (SELECT h.host, h.text, sum(n) FILTER (f.line IS NOT NULL) AS lost, sum(n) AS words FROM h LEFT JOIN f ON h.host = f.host AND h.line = f.line GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND coalesce(lost, 0) <= {max_lost} * coalesce(words, 0) AS kept
FROM b LEFT JOIN x ON b.host = x.host AND b.text = x.text
""".replace("{least}", str(LEAST)).replace("{share}", str(SHARE)).replace("{most}", str(MOST)).replace("{max_lost}", str(MAX_LOST))
