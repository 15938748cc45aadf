"""Small tables with what operators must survive: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while seven old wizards mix a strange brew of herbs and roots"


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (None, "lost row without an id"), (5, " \n\t "), (6, "word " * 6000),
            (7, "Été naïve 漢字   x's don't  \n\n end\x00"), (8, PROSE.upper() + "!"), (9, "x" * 500), (10, "a b c d")]
    return [(i, t, None, None if i == 7 else "src", 0) for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Extra columns carry names that operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, DOCS)
    for name in ("score", "tokens", "fp", "kept", "_host", "shard", "key", "found", "all", "sequence_id", "ids", "held_out", "predicted"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
