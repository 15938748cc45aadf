"""The corpus pipeline: `STAGES` in order, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowsieve.llm import gbt, line_rules, packing, partenum, secrets
from flowsieve.llm.common import table
from flowsieve.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees predict to be of quality; the others go."""
    return gbt.keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not made of their host's frequent lines."""
    return line_rules.keep_sound(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near or exact copies."""
    return partenum.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced by a mark."""
    return secrets.redact_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 1024 tokens."""
    return packing.digests(packing.pack_documents(docs))


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules), ("jaccard_join", jaccard_join),
          ("secret_scan", secret_scan), ("packing", packed)]
#: SQL cannot state fitted trees, entropy windows and tokens; tests hold every stage to a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
