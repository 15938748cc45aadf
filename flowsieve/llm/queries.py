"""Registered queries of the corpus operators, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsieve.llm import bpe, gbt, int8_tiles, line_rules, ngram_trie, packing, partenum, pii, resample, secrets, training_order, vptree, walsh
from flowsieve.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return register


@query("op1_nearest", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=vptree.FACTOR)


@query("op6_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query("op7_quality_trees")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gbt.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_line_rules", line_rules.ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_rules(table(spark, sf_dir, "documents"))


@query("op5_training_order")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = training_order.materialised(table(spark, sf_dir, "documents"))
    return slots.select("slot", "shard", "byte_offset", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"))


@query("op9_byte_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack_documents(table(spark, sf_dir, "documents")))


@query("op3_jaccard_join", partenum.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.jaccard_join(table(spark, sf_dir, "documents"))


@query("op4_ngram_trie")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.lm_scores(table(spark, sf_dir, "documents"))


def _of_kind(kind: str):
    return lambda x: x["kind"] == kind


@query("op2_feistel_pseudonyms")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = pii.pseudonymised(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("found"), _of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return named.select("doc_id", "text", *counts, F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["value"])).alias("pseudonyms"))


@query("op11_walsh_clusters", walsh.oracle())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walsh.clustered(table(spark, sf_dir, "embeddings"))


@query("op12_int8_dedup", int8_tiles.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return int8_tiles.linked_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_resample", resample.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
