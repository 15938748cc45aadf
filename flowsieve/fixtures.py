"""Network-flow shaped inputs derived from the given tables.

Each text is plain SQL that Spark and DuckDB both run, so the check queries start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import materialize

PACKETS_SQL = """
SELECT event_id AS packet_id, ts, event_id % 97 <> 0 AS is_ip, proto,
       CASE WHEN resp THEN server ELSE client END AS src_ip,
       CASE WHEN resp THEN client ELSE server END AS dst_ip,
       CASE WHEN resp THEN 443 ELSE 1024 + user_id END AS src_port,
       CASE WHEN resp THEN 1024 + user_id ELSE 443 END AS dst_port,
       length
FROM (SELECT event_id, ts, user_id, resp, client, proto, length,
             CASE WHEN user_id % 50 = 7 THEN client
                  WHEN user_id % 2 = 1 THEN '1.1.1.' || CAST(user_id % 5 AS STRING)
                  ELSE '192.168.0.' || CAST(user_id % 5 AS STRING) END AS server
      FROM (SELECT event_id, ts, user_id, event_type IN ('error','signup') AS resp,
                   '10.0.' || CAST(CAST(floor(user_id / 256) AS INT) AS STRING) || '.' || CAST(user_id % 256 AS STRING) AS client,
                   CASE WHEN user_id % 10 = 0 THEN 1 WHEN user_id % 10 < 4 THEN 17 ELSE 6 END AS proto,
                   least(1500, 40 + CAST(floor(value * 10) AS BIGINT)) AS length
            FROM {events}) a) b
"""

_LINES_SQL = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
         || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING) AS row_id,
       l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_quantity AS q,
       l_extendedprice AS px, l_discount AS dc,
       CASE WHEN (l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 100 < 15 THEN 1 ELSE 0 END AS a
FROM {lineitem}
"""

# `copy` numbers the injected duplicates, so (row_id, copy) is unique; it is left out of full-row dedup.
FLOWS_SQL = f"""
WITH f AS (
SELECT row_id, ok, pk, sk, a,
  px * 100 * (1 - 0.7e0 * a) AS flow_duration, q + 20 * a AS fwd_packets, CAST(ln AS DOUBLE) AS bwd_packets,
  q * 60 * (1 + 2 * a) AS fwd_len_total, ln * 200.0e0 AS bwd_len_total,
  60.0e0 + pk % 1400 AS fwd_len_max, CAST(sk % 41 AS DOUBLE) AS fwd_len_min, q * 60 * (1 + 2 * a) / (q + 20 * a) AS fwd_len_mean,
  200.0e0 + sk % 1000 AS bwd_len_max, ln * 10.0e0 AS bwd_len_min, ln * 200.0e0 / ln AS bwd_len_mean, dc
FROM ({_LINES_SQL}) t
),
g AS (
SELECT row_id, flow_duration, fwd_packets, bwd_packets, fwd_len_total, bwd_len_total, fwd_len_max, fwd_len_min, fwd_len_mean,
  bwd_len_max, bwd_len_min, bwd_len_mean,
  CASE WHEN pk % 97 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE (fwd_len_total + bwd_len_total) / (flow_duration / 1e6) END AS flow_bytes_s,
  CASE WHEN pk % 89 = 0 THEN CAST('NaN' AS DOUBLE) ELSE (fwd_packets + bwd_packets) / (flow_duration / 1e6) END AS flow_packets_s,
  flow_duration / (fwd_packets + bwd_packets) AS flow_iat_mean,
  CASE WHEN pk % 83 = 0 THEN NULL ELSE flow_duration * (0.3e0 + dc) END AS flow_iat_max,
  CASE WHEN a = 1 THEN CASE WHEN sk % 2 = 0 THEN 'DDoS-Attack' ELSE ' PortScan' END
       ELSE CASE sk % 4 WHEN 0 THEN 'BENIGN' WHEN 1 THEN ' benign ' WHEN 2 THEN '0' ELSE 'Normal' END END AS label,
  CASE ok % 8 WHEN 0 THEN 'Monday-WorkingHours.csv' WHEN 1 THEN 'Tuesday-WorkingHours.csv' WHEN 2 THEN 'Wednesday-WorkingHours.csv'
       WHEN 3 THEN 'Thursday-Morning-WebAttacks.csv' WHEN 4 THEN 'Thursday-Afternoon-Infilteration.csv' WHEN 5 THEN 'Friday-Morning.csv'
       WHEN 6 THEN 'Friday-Afternoon-PortScan.csv' ELSE 'Friday-Afternoon-DDos.csv' END AS source_file, ok
FROM f)
SELECT g.*, 0 AS copy FROM g UNION ALL SELECT g.*, 1 AS copy FROM g WHERE ok % 50 = 0
"""

SCORES_SQL = f"""
SELECT row_id, a AS y, ((ok * 7919 + ln * 104729) % 70 + 30 * a) / 100.0e0 AS p1,
       ((ok * 6007 + pk * 131) % 60 + 40 * a) / 100.0e0 AS p2,
       CASE WHEN (ok + pk) % 100 = 0 THEN 1 ELSE 0 END AS anomaly
FROM ({_LINES_SQL}) t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_TASK = 2_000_000
_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, text: str, **tables: str) -> DataFrame:
    """The derived table, written once per application so that queries read columns, not long expressions.

    A table of fewer files than cores (the given ones are single files of one row group) is spread over as many tasks
    as its rows ask for; larger ones keep the partitions they were read in.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        derived = spark.sql(text, **{arg: table(spark, sf_dir, t) for arg, t in tables.items()})
        cores, read = spark.sparkContext.defaultParallelism, derived.rdd.getNumPartitions()
        if read < cores:
            derived = derived.repartition(max(cores, -(-derived.count() // ROWS_PER_TASK)))
        _STORED[key] = materialize(derived, name)
    return _STORED[key]


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "packets", PACKETS_SQL, events="events")


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "flows", FLOWS_SQL, lineitem="lineitem")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "scores", SCORES_SQL, lineitem="lineitem")


def duckdb_text(sql: str) -> str:
    """The same text with table names in place of the DataFrame placeholders."""
    return sql.format(events="events", lineitem="lineitem")
