"""Check queries: each entry pairs a query over the given tables with the same result as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import (
    attack_family, band, binarize, guarded_rate, min_proba, sigmoid, step, strip,
)
from ..operators import alerts as al
from ..operators import cascade as ca
from ..operators import cleaning as cl
from ..operators import curves as cu
from ..operators import flows as fl
from ..operators import metrics as me
from ..operators import sampling as sa
from ..operators import scaling as sc
from ..schema import FEATURES, FLOW_KEY, SEED
from ..session import attach, materialize, scratch_path
from ..sources import (
    load_table, read_flows, read_packets, resolve_source, save_table, stage_flows, write_metrics,
)
from ..sources import flows as flow_files
from ..sources.mock import mock_columns
from ..sources.packets import write_packets

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query
    return register


# ---------------------------------------------------------------- shared SQL

PACKETS = fx.duckdb_text(fx.PACKETS_SQL)
FLOWS = fx.duckdb_text(fx.FLOWS_SQL)
SCORES = fx.duckdb_text(fx.SCORES_SQL)

KEY = ", ".join(FLOW_KEY)

WITH_NORMALIZED = f"""
packets AS ({PACKETS}),
n AS (SELECT packet_id, ts, epoch_us(ts) AS us, proto, src_ip, dst_ip, length,
        CASE WHEN proto IN (6,17) THEN src_port ELSE 0 END AS src_port,
        CASE WHEN proto IN (6,17) THEN dst_port ELSE 0 END AS dst_port
      FROM packets WHERE is_ip)"""

WITH_KEYED = WITH_NORMALIZED + """,
k AS (SELECT *, CASE WHEN src_ip < dst_ip THEN 1 ELSE 0 END AS fwd,
        CASE WHEN src_ip < dst_ip THEN src_ip ELSE dst_ip END AS ip_a,
        CASE WHEN src_ip < dst_ip THEN dst_ip ELSE src_ip END AS ip_b,
        CASE WHEN src_ip < dst_ip THEN src_port ELSE dst_port END AS port_a,
        CASE WHEN src_ip < dst_ip THEN dst_port ELSE src_port END AS port_b FROM n)"""

WITH_WINDOWS = WITH_KEYED + f""",
o AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY us, packet_id) - 1 AS ord FROM k),
w AS (SELECT *, CAST(floor(ord / 10) AS BIGINT) AS win FROM o),
i AS (SELECT *, us - coalesce(lag(us) OVER (PARTITION BY {KEY}, win ORDER BY us, packet_id), us) AS iat,
        count(*) OVER (PARTITION BY {KEY}, win) AS in_window FROM w)"""

FLOW_SELECT = f"""
SELECT {KEY}, win, max(us) - min(us) AS flow_duration,
  CAST(sum(fwd) AS BIGINT) AS fwd_packets, CAST(sum(1 - fwd) AS BIGINT) AS bwd_packets,
  CAST(coalesce(sum(CASE WHEN fwd = 1 THEN length END), 0) AS BIGINT) AS fwd_len_total,
  CAST(coalesce(sum(CASE WHEN fwd = 0 THEN length END), 0) AS BIGINT) AS bwd_len_total,
  coalesce(max(CASE WHEN fwd = 1 THEN length END), 0) AS fwd_len_max,
  coalesce(min(CASE WHEN fwd = 1 THEN length END), 0) AS fwd_len_min,
  coalesce(avg(CASE WHEN fwd = 1 THEN length END), 0) AS fwd_len_mean,
  coalesce(max(CASE WHEN fwd = 0 THEN length END), 0) AS bwd_len_max,
  coalesce(min(CASE WHEN fwd = 0 THEN length END), 0) AS bwd_len_min,
  coalesce(avg(CASE WHEN fwd = 0 THEN length END), 0) AS bwd_len_mean,
  sum(iat) / 10.0e0 AS flow_iat_mean, max(iat) AS flow_iat_max
FROM i GROUP BY {KEY}, win HAVING count(*) = 10"""

FLOW_OUTPUT = f"""
SELECT {KEY}, win, flow_duration, fwd_packets, bwd_packets, fwd_len_total, bwd_len_total,
  fwd_len_max, fwd_len_min, round(fwd_len_mean, 6) AS fwd_len_mean,
  bwd_len_max, bwd_len_min, round(bwd_len_mean, 6) AS bwd_len_mean,
  CASE WHEN flow_duration > 0 THEN round((fwd_len_total + bwd_len_total) / (flow_duration / 1e6), 6) ELSE 0 END AS flow_bytes_s,
  CASE WHEN flow_duration > 0 THEN round((fwd_packets + bwd_packets) / (flow_duration / 1e6), 6) ELSE 0 END AS flow_packets_s,
  round(flow_iat_mean, 6) AS flow_iat_mean, flow_iat_max
FROM g"""

FINITE = " AND ".join(f"{f} IS NOT NULL AND isfinite({f})" for f in FEATURES)
STRIPPED = r"regexp_replace(label, '^\s+|\s+$', '', 'g')"
TARGET = f"CASE WHEN lower({STRIPPED}) IN ('benign', '0', 'normal') THEN 0 ELSE 1 END"
FAMILY = """CASE WHEN contains(lower(source_file), 'ddos') THEN 'DDoS'
  WHEN contains(lower(source_file), 'portscan') THEN 'PortScan'
  WHEN contains(lower(source_file), 'tuesday') THEN 'Patator (FTP/SSH)'
  WHEN contains(lower(source_file), 'wednesday') THEN 'DoS (Hulk/GoldenEye/Slow)'
  WHEN contains(lower(source_file), 'webattacks') THEN 'Web Attacks (SQL/XSS/BF)'
  WHEN contains(lower(source_file), 'infilteration') THEN 'Infiltration'
  WHEN contains(lower(source_file), 'morning') THEN 'Botnet' ELSE 'Benign' END"""

WITH_CLEAN = f"""flows AS ({FLOWS}), clean AS (SELECT * FROM flows WHERE {FINITE})"""
# One row per distinct flow with its target; the base of everything from sampling onwards.
WITH_ROWS = WITH_CLEAN + f""",
rows_y AS (SELECT *, {TARGET} AS y FROM (SELECT DISTINCT * EXCLUDE (copy) FROM clean))"""


def sql_draw(*keys: str, step: str | None = None) -> str:
    seed = f"{SEED}:{step}" if step else SEED
    return f"md5(concat_ws('|', '{seed}', {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def clean_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.drop_non_finite(fx.flows(spark, sf_dir))


def distinct_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.with_target(cl.drop_duplicates(clean_flows(spark, sf_dir), ignore=("copy",)))


def written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows written once, for operators that pass over their input more than once."""
    return materialize(distinct_flows(spark, sf_dir), "distinct")


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Round double columns so that two engines' last bits cannot differ."""
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles if only is None or c in only})


# ---------------------------------------------------------------- flow assembly

@check("packet_source", f"""
WITH p AS ({PACKETS})
SELECT proto, count(*) AS packets, CAST(sum(length) AS BIGINT) AS bytes, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us
FROM p WHERE is_ip GROUP BY proto""")
def packet_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "packets")
    write_packets(fx.packets(spark, sf_dir), path)
    us = F.unix_micros("ts")
    return read_packets(spark, path).groupBy("proto").agg(
        F.count("*").alias("packets"), F.sum("length").alias("bytes"),
        F.min(us).alias("first_us"), F.max(us).alias("last_us"))


@check("packet_normalize", f"""
WITH {WITH_NORMALIZED} SELECT packet_id, us, proto, src_ip, dst_ip, src_port, dst_port, length FROM n""")
def packet_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.packet_normalize(fx.packets(spark, sf_dir)).drop("ts")


@check("flow_key", f"""
WITH {WITH_KEYED} SELECT packet_id, {KEY}, fwd FROM k""")
def flow_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.keyed_packets(fx.packets(spark, sf_dir)).select("packet_id", *FLOW_KEY, "fwd")


@check("count_windows", f"""
WITH {WITH_WINDOWS} SELECT packet_id, {KEY}, win, ord FROM i WHERE in_window = 10""")
def count_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = fl.keyed_packets(fx.packets(spark, sf_dir))
    return fl.count_windows(keyed).select("packet_id", *FLOW_KEY, "win", "ord")


@check("count_windows_sliced", f"""
WITH {WITH_WINDOWS} SELECT packet_id, {KEY}, win, ord, iat FROM i WHERE in_window = 10""")
def count_windows_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small ranges, so that keys and windows lie across their borders."""
    keyed = fl.keyed_packets(fx.packets(spark, sf_dir))
    return fl.count_windows(keyed, parts=61).select("packet_id", *FLOW_KEY, "win", "ord", "iat")


@check("flow_iat", f"""
WITH {WITH_WINDOWS} SELECT {KEY}, win, packet_id, us, iat FROM i WHERE in_window = 10""")
def flow_iat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.flow_iat(fl.keyed_packets(fx.packets(spark, sf_dir)))


@check("flow_features", f"WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT}) {FLOW_OUTPUT}")
def flow_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fl.flow_features(fl.keyed_packets(fx.packets(spark, sf_dir))))


@check("flow_endpoints", f"""
WITH {WITH_WINDOWS} SELECT {KEY}, win, src_ip, dst_ip, src_port, dst_port FROM i WHERE in_window = 10 AND ord % 10 = 0""")
def flow_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fl.flow_endpoints(fl.keyed_packets(fx.packets(spark, sf_dir)))


# ---------------------------------------------------------------- sources, cleaning, labels

@check("flow_csv_source", f"""
WITH flows AS ({FLOWS})
SELECT source_file, {FAMILY} AS attack_type, count(*) AS n,
  count(*) FILTER (WHERE isfinite(flow_bytes_s)) AS finite_bytes, count(flow_iat_max) AS with_iat,
  count(*) FILTER (WHERE label = ' PortScan') AS padded_labels, CAST(sum(fwd_packets) AS BIGINT) AS fwd_packets
FROM flows WHERE NOT contains(lower(source_file), 'mock') AND NOT contains(lower(source_file), 'monday')
GROUP BY source_file""")
def flow_csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "flow-csv")
    flow_files.write_flows_csv(fx.flows(spark, sf_dir), path)
    read = cl.clean_columns(read_flows(spark, path, flow_files.CROSS_EVAL_EXCLUDE))
    finite = F.col("flow_bytes_s").isNotNull() & (F.abs("flow_bytes_s") != float("inf"))
    return read.groupBy("source_file").agg(
        F.count("*").alias("n"), F.count_if(finite).alias("finite_bytes"), F.count("flow_iat_max").alias("with_iat"),
        F.count_if(F.col("Label") == " PortScan").alias("padded_labels"),
        F.sum("fwd_packets").cast("long").alias("fwd_packets"),
    ).withColumn("attack_type", attack_family(F.col("source_file")))


@check("source_fallback", f"""
WITH {WITH_CLEAN} SELECT {TARGET} AS y, count(*) AS n, round(avg(fwd_packets), 6) AS fwd_packets FROM clean GROUP BY 1""")
def source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The real path is absent, so the stand-in is generated from the flows, saved and then used."""
    base = scratch_path(spark, "fallback")
    generate = lambda: clean_flows(spark, sf_dir).withColumnRenamed("label", "Label").drop("source_file", "copy")
    path = resolve_source(spark, f"{base}/real.csv", f"{base}/mock.csv", generate)
    resolve_source(spark, f"{base}/real.csv", path, generate)
    return rounded(cl.with_target(read_flows(spark, path)).groupBy("y").agg(
        F.count("*").alias("n"), F.avg("fwd_packets").alias("fwd_packets")))


_MOCK_UNIFORM = "CAST(('0x' || substr({}, 1, 8)) AS BIGINT) / 4294967296.0e0"
_MOCK_SQL = ", ".join(
    f"round(-100.0e0 * ln(1.0e0 - {_MOCK_UNIFORM.format(sql_draw(repr(f), 'row_id'))}), 6) AS {f}" for f in FEATURES)


@check("mock_flows", f"""
WITH flows AS ({FLOWS})
SELECT row_id, {_MOCK_SQL},
  CASE WHEN {_MOCK_UNIFORM.format(sql_draw("'label'", 'row_id'))} < 0.85 THEN 'BENIGN' ELSE 'DDoS-Attack' END AS label
FROM flows WHERE copy = 0""")
def mock_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One generated flow per row of the flow table, drawn from its id."""
    ids = fx.flows(spark, sf_dir).where("copy = 0")
    return rounded(ids.select("row_id", *mock_columns(F.col("row_id"))))


@check("clean_columns", f"""
WITH flows AS ({FLOWS}) SELECT row_id, copy, label, source_file FROM flows""")
def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = fx.flows(spark, sf_dir).select("row_id", "copy", "label", "source_file").toDF(" row_id", "copy\t", " label ", "source_file")
    return cl.clean_columns(padded)


@check("attack_family", f"""
WITH flows AS ({FLOWS}) SELECT source_file, {FAMILY} AS attack_type, count(*) AS n FROM flows GROUP BY source_file""")
def attack_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fx.flows(spark, sf_dir).groupBy("source_file").agg(F.count("*").alias("n"))
    return counts.withColumn("attack_type", attack_family(F.col("source_file")))


_DOWNSIZE_COLUMNS = [*FEATURES, "ok", "copy"]
_TYPE_NAMES = {"ok": "bigint", "copy": "int"}


def _downsize_sql(c: str) -> str:
    whole = c in _TYPE_NAMES
    lo, hi = f"min({c})", f"max({c})"
    if whole:
        chosen = " ".join(f"WHEN {lo} > {-2 ** (b - 1)} AND {hi} < {2 ** (b - 1) - 1} THEN 'int{b}'" for b in (8, 16, 32))
        chosen = f"CASE {chosen} ELSE 'int64' END"
    else:
        chosen = f"CASE WHEN {lo} > -3.4028234663852886e38 AND {hi} < 3.4028234663852886e38 THEN 'float32' ELSE 'float64' END"
    return (f"SELECT '{c}' AS \"column\", '{_TYPE_NAMES.get(c, 'double')}' AS current, round(CAST({lo} AS DOUBLE), 3) AS lo, "
            f"round(CAST({hi} AS DOUBLE), 3) AS hi, {chosen} AS chosen FROM clean")


@check("downsize_types", f"WITH {WITH_CLEAN} " + " UNION ALL ".join(_downsize_sql(c) for c in _DOWNSIZE_COLUMNS))
def downsize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cl.downsize(clean_flows(spark, sf_dir), _DOWNSIZE_COLUMNS), 3)


@check("drop_non_finite", f"WITH {WITH_CLEAN} SELECT row_id, copy, label FROM clean")
def drop_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_flows(spark, sf_dir).select("row_id", "copy", "label")


_WITHOUT = ["bwd_len_min", "flow_iat_max"]


@check("select_features", f"WITH {WITH_CLEAN} SELECT row_id, copy, " + ", ".join(
    f"0.0e0 AS {f}" if f in _WITHOUT else f"round(CAST({f} AS DOUBLE), 6) AS {f}" for f in FEATURES) + " FROM clean")
def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cl.conform(clean_flows(spark, sf_dir).drop(*_WITHOUT), keep=("row_id", "copy")))


@check("float32_types", f"WITH {WITH_CLEAN} SELECT row_id, copy, " + ", ".join(
    f"CASE WHEN {f} = floor({f}) THEN {f} ELSE CAST(CAST({f} AS FLOAT) AS DOUBLE) END AS {f}" for f in FEATURES) + " FROM clean")
def float32_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.model_types(cl.conform(clean_flows(spark, sf_dir), keep=("row_id", "copy")))


@check("label_column", f"WITH flows AS ({FLOWS}) SELECT 'label' AS label_column, label, count(*) AS n FROM flows GROUP BY label")
def label_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = fx.flows(spark, sf_dir)
    found = cl.find_label(flows)
    return (flows.groupBy(F.col(found).alias("label")).agg(F.count("*").alias("n"))
            .withColumn("label_column", F.lit(found)))


@check("binarize_label", f"WITH flows AS ({FLOWS}) SELECT label, {TARGET} AS y, count(*) AS n FROM flows GROUP BY label")
def binarize_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (fx.flows(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
            .withColumn("y", binarize(F.col("label"))))


@check("benign_only", f"WITH {WITH_ROWS} SELECT row_id, source_file FROM rows_y WHERE y = 0")
def benign_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.benign_only(distinct_flows(spark, sf_dir)).select("row_id", "source_file")


@check("label_counts", f"WITH flows AS ({FLOWS}) SELECT label, count(*) AS n FROM flows GROUP BY label ORDER BY n DESC, label")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.label_counts(fx.flows(spark, sf_dir))


# ---------------------------------------------------------------- distinct, sampling, splitting, union

@check("drop_duplicates", f"""
WITH {WITH_CLEAN} SELECT (SELECT count(*) FROM clean) AS rows_before, count(*) AS rows_after,
  (SELECT count(*) FROM clean) - count(*) AS removed FROM (SELECT DISTINCT * EXCLUDE (copy) FROM clean)""")
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.duplicate_counts(clean_flows(spark, sf_dir), ignore=("copy",))


@check("distinct_rows", f"WITH {WITH_ROWS} SELECT row_id, label, source_file, ok, y FROM rows_y")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_flows(spark, sf_dir).select("row_id", "label", "source_file", "ok", "y")


@check("sample_n", f"""
WITH {WITH_CLEAN} SELECT row_id, copy, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {sql_draw('row_id', 'copy')}) AS rn FROM clean)
WHERE rn <= 1000""")
def sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.sample_n(clean_flows(spark, sf_dir), 1000, ["row_id", "copy"], by="source_file").select("row_id", "copy", "source_file")


@check("sample_n_refined", f"""
WITH {WITH_CLEAN} SELECT row_id, copy, source_file FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {sql_draw('row_id', 'copy')}) AS rn FROM clean)
WHERE rn <= 1000""")
def sample_n_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.sample_n(clean_flows(spark, sf_dir), 1000, ["row_id", "copy"], by="source_file", ranked_rows=1).select("row_id", "copy", "source_file")


@check("sample_single", f"""
WITH {WITH_CLEAN} SELECT row_id, copy FROM clean ORDER BY {sql_draw('row_id', 'copy')} LIMIT 50000""")
def sample_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.sample_n(clean_flows(spark, sf_dir), 50_000, ["row_id", "copy"]).select("row_id", "copy")


_FIRST_HALF = "source_file < 'M'"


@check("union_sources", f"""
WITH {WITH_CLEAN} SELECT row_id, copy, source_file, CASE WHEN {_FIRST_HALF} THEN flow_bytes_s END AS flow_bytes_s FROM clean""")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = clean_flows(spark, sf_dir).select("row_id", "copy", "source_file", "flow_bytes_s")
    return cl.union_all(clean.where(_FIRST_HALF), clean.where(f"NOT {_FIRST_HALF}").drop("flow_bytes_s"))


# Training rows as SQL: balanced 1:1, capped at 40,000, split 80/20, by the same draws.
WITH_BALANCED = WITH_ROWS + f""",
attacks AS (SELECT count(*) AS n FROM rows_y WHERE y = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sql_draw('row_id', step='balance')}) AS rn FROM rows_y),
balanced AS (SELECT * EXCLUDE (rn) FROM ranked WHERE y = 1 OR rn <= (SELECT n FROM attacks))"""


@check("undersample", f"WITH {WITH_BALANCED} SELECT row_id, y FROM balanced")
def undersample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.undersample(written_rows(spark, sf_dir), ["row_id"]).select("row_id", "y")


@check("stratified_cap", f"""
WITH {WITH_ROWS} SELECT row_id, y FROM (
  SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {sql_draw('row_id', step='cap')}) AS rn FROM rows_y)
WHERE rn <= 20000 OR (SELECT count(*) FROM rows_y) <= 40000""")
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.stratified_cap(written_rows(spark, sf_dir), key=["row_id"]).select("row_id", "y")


@check("shuffle", f"""
WITH {WITH_ROWS} SELECT row_id, row_number() OVER (ORDER BY {sql_draw('row_id', step='shuffle')}, row_id) AS position FROM rows_y""")
def shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions are read off the sorted output: rows before a partition plus the place inside it."""
    kept = materialize(sa.shuffle(distinct_flows(spark, sf_dir).select("row_id"), ["row_id"])
                       .select("row_id", F.monotonically_increasing_id().alias("at")), "shuffled")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    numbered = attach(kept.withColumn("part", part), sizes, ["part"])
    return numbered.select("row_id", (F.col("before") + place + 1).alias("position"))


@check("train_test_split", f"""
WITH {WITH_ROWS} SELECT row_id, y, rn <= ceil(0.2 * (SELECT count(*) FROM rows_y)) AS is_test FROM (
  SELECT row_id, y, row_number() OVER (ORDER BY {sql_draw('row_id', step='split')}) AS rn FROM rows_y)""")
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.mark_test(written_rows(spark, sf_dir), key=["row_id"]).select("row_id", "y", "is_test")


@check("class_sample", f"""
WITH {WITH_ROWS} SELECT row_id, y FROM (
  SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {sql_draw('row_id', step='class')}) AS rn FROM rows_y) WHERE rn <= 150""")
def class_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sa.class_sample(written_rows(spark, sf_dir), key=["row_id"]).select("row_id", "y")


@check("align_xy", f"""
WITH {WITH_ROWS}, scores AS (SELECT DISTINCT row_id, p1 FROM ({SCORES}))
SELECT r.row_id, r.y, s.p1 FROM rows_y r JOIN scores s ON r.row_id = s.row_id""")
def align_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fx.scores(spark, sf_dir).select("row_id", "p1").distinct()
    return cl.align_xy(distinct_flows(spark, sf_dir).select("row_id", "y"), scored)


# ---------------------------------------------------------------- scaling and grid

# Rows in the precision the models see, with the fitted scaler beside them.
F32 = ", ".join(f"CASE WHEN {f} = floor({f}) THEN {f} ELSE CAST(CAST({f} AS FLOAT) AS DOUBLE) END AS {f}" for f in FEATURES)
SCALER_STATS = ", ".join(
    f"avg({f}) AS m_{f}, CASE WHEN min({f}) = max({f}) THEN 1.0e0 ELSE stddev_pop({f}) END AS s_{f}" for f in FEATURES)
WITH_SCALER = WITH_ROWS + f""",
narrow AS (SELECT row_id, label, source_file, y, {F32} FROM rows_y),
scaler AS (SELECT {SCALER_STATS} FROM narrow)"""
SCALED = ", ".join(f"(t.{f} - s.m_{f}) / s.s_{f} AS {f}" for f in FEATURES)


def narrow_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cl.with_target(cl.distinct_by_hash(clean_flows(spark, sf_dir), ("copy",)))
    return cl.model_types(cl.conform(rows, strict=True, keep=("row_id", "label", "source_file", "y")))


@check("scaler_fit", f"WITH {WITH_SCALER} " + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(m_{f}, 2) AS mean, round(s_{f}, 2) AS scale FROM scaler" for f in FEATURES))
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sc.scaler_fit(narrow_flows(spark, sf_dir)), 2)


@check("scaler_apply", f"WITH {WITH_SCALER} SELECT row_id, " + ", ".join(
    f"round((t.{f} - s.m_{f}) / s.s_{f}, 6) AS {f}" for f in FEATURES) + " FROM narrow t CROSS JOIN scaler s")
def scaler_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit and scale read the same written rows, so duplicates are dropped once."""
    narrow = materialize(narrow_flows(spark, sf_dir).select("row_id", *FEATURES), "narrow")
    params = sc.scaler_params(sc.scaler_fit(narrow))
    return rounded(sc.scaler_apply(narrow, params).select("row_id", *FEATURES))


@check("feature_grid", f"""
WITH {WITH_CLEAN},
b AS (SELECT min(flow_duration) AS xl, max(flow_duration) AS xh, min(fwd_len_max) AS yl, max(fwd_len_max) AS yh, """ + ", ".join(
    f"avg({f}) AS {f}" for f in FEATURES if f not in ("flow_duration", "fwd_len_max")) + """ FROM clean),
c AS (SELECT CAST(range AS INTEGER) AS cell FROM range(1600))
SELECT cell, CAST(cell % 40 AS INTEGER) AS ix, CAST(cell // 40 AS INTEGER) AS iy, """ + ", ".join(
    "round(CASE WHEN cell % 40 = 39 THEN xh ELSE xl + (cell % 40) * ((xh - xl) / 39.0e0) END, 2) AS flow_duration" if f == "flow_duration"
    else "round(CASE WHEN cell // 40 = 39 THEN yh ELSE yl + (cell // 40) * ((yh - yl) / 39.0e0) END, 2) AS fwd_len_max" if f == "fwd_len_max"
    else f"round({f}, 2) AS {f}" for f in FEATURES) + " FROM b CROSS JOIN c")
def feature_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sc.feature_grid(clean_flows(spark, sf_dir)), 2)


@check("linspace", f"""
WITH b AS (SELECT min(p1) AS lo, max(p1) AS hi FROM ({SCORES}))
SELECT CAST(range AS INTEGER) AS i, round(CASE WHEN range = 99 THEN hi ELSE lo + range * ((hi - lo) / 99.0e0) END, 9) AS point
FROM b, range(100)""")
def linspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = fx.scores(spark, sf_dir).agg(F.min("p1").alias("lo"), F.max("p1").alias("hi"))
    return rounded(sc.linspace(bounds, "lo", "hi", 100), 9)


# ---------------------------------------------------------------- metrics and curves over given scores

WITH_SCORED = f"""
scores AS (SELECT *, CAST(p1 >= 0.5 AND p2 >= 0.5 AS INTEGER) AS pred, least(p1, p2) AS proba FROM ({SCORES})),
long AS (SELECT row_id, y, 'l1' AS model, CAST(p1 >= 0.5 AS INTEGER) AS pred, p1 AS proba FROM scores
  UNION ALL SELECT row_id, y, 'l2', CAST(p2 >= 0.5 AS INTEGER), p2 FROM scores
  UNION ALL SELECT row_id, y, 'cascade', pred, proba FROM scores)"""
CONFUSION = """count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp"""
RATES = """CASE WHEN tp + fn > 0 THEN tp / (tp + fn) * 100.0e0 ELSE 0 END AS recall,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) * 100.0e0 ELSE 0 END AS tnr,
  CASE WHEN tn + fp > 0 THEN fp / (tn + fp) * 100.0e0 ELSE 0 END AS fpr,
  (tp + tn) / (tn + fp + fn + tp) * 100.0e0 AS accuracy"""


def _bayes_sql(theta: str) -> str:
    hit, false_alarm = f"recall / 100.0e0 * {theta}", f"fpr / 100.0e0 * (1.0e0 - {theta})"
    return f"CASE WHEN {hit} + {false_alarm} > 0 THEN ({hit}) / ({hit} + {false_alarm}) * 100.0e0 ELSE 0 END"


WITH_RATES = WITH_SCORED + f""",
cm AS (SELECT model, {CONFUSION} FROM long GROUP BY model),
rated AS (SELECT *, {RATES} FROM cm)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_proba(ca.cascade_threshold(fx.scores(spark, sf_dir)))


def long_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = scored(spark, sf_dir)
    hit = lambda p: (F.col(p) >= 0.5).cast("int")
    wide = s.select("row_id", "y", hit("p1").alias("pred_l1"), F.col("p1").alias("p_l1"), hit("p2").alias("pred_l2"),
                    F.col("p2").alias("p_l2"), F.col("pred").alias("pred_cascade"), F.col("proba").alias("p_cascade"))
    return me.long_scores(wide, ["l1", "l2", "cascade"])


@check("confusion", f"WITH {WITH_SCORED} SELECT model, {CONFUSION} FROM long GROUP BY model")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.confusion(long_scored(spark, sf_dir), ["model"])


@check("rates", f"WITH {WITH_RATES} SELECT model, round(recall, 6) AS recall, round(tnr, 6) AS tnr, round(fpr, 6) AS fpr, round(accuracy, 6) AS accuracy FROM rated")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = me.confusion(long_scored(spark, sf_dir), ["model"])
    return rounded(me.rates(cm).select("model", "recall", "tnr", "fpr", "accuracy"))


@check("bayes_detection_rate", f"""
WITH {WITH_RATES}, thetas AS (SELECT unnest([0.001e0, 0.05e0]) AS theta)
SELECT model, theta, round({_bayes_sql('theta')}, 6) AS bayes FROM rated CROSS JOIN thetas""")
def bayes_detection_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = me.rates(me.confusion(long_scored(spark, sf_dir), ["model"]))
    return rounded(me.bayes_rate(rated, [0.001, 0.05]).select("model", "theta", "bayes"))


# Lines of a classification report over rows of (model, y, pred).
REPORT_LINES = f"""cm AS (SELECT model, {CONFUSION} FROM long GROUP BY model),
c AS (SELECT model, 'Benign' AS class, tn AS hit, tn + fn AS predicted, tn + fp AS support FROM cm
      UNION ALL SELECT model, 'Attack', tp, tp + fp, tp + fn FROM cm),
f AS (SELECT model, class, support, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS p,
      CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r,
      CASE WHEN predicted + support > 0 THEN 2 * hit / (predicted + support) ELSE 0 END AS f1, hit FROM c)
SELECT model, class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT model, 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY model
UNION ALL SELECT model, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f GROUP BY model"""


@check("classification_report", f"WITH {WITH_SCORED}, {REPORT_LINES}")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(me.classification_report(me.confusion(long_scored(spark, sf_dir), ["model"])))


@check("prediction_mix", f"""
WITH {WITH_SCORED} SELECT model, count(*) AS total, count(*) FILTER (WHERE pred = 0) AS benign,
  count(*) FILTER (WHERE pred = 1) AS attack, round(count(*) FILTER (WHERE pred = 1) / count(*) * 100.0e0, 6) AS attack_pct
FROM long GROUP BY model""")
def prediction_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(me.prediction_mix(long_scored(spark, sf_dir), ["model"]))


# Given scores put beside the source of their flow.
WITH_SOURCED = WITH_CLEAN + f""",
once AS (SELECT DISTINCT row_id, p1, p2 FROM ({SCORES})),
sourced AS (SELECT c.source_file, {TARGET} AS y, CAST(s.p1 >= 0.5 AND s.p2 >= 0.5 AS INTEGER) AS pred
  FROM clean c JOIN once s ON c.row_id = s.row_id
  WHERE NOT contains(lower(source_file), 'monday') AND NOT contains(lower(source_file), 'mock'))"""
CROSS_TABLE = WITH_SOURCED + f""",
cm AS (SELECT source_file, {CONFUSION} FROM sourced GROUP BY source_file),
cross_table AS (SELECT source_file, {FAMILY} AS attack_type, tn + fp + fn + tp AS samples, tn + fp AS benign, tp + fn AS attack,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) * 100.0e0 ELSE 0 END, 6) AS recall,
  round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) * 100.0e0 ELSE 100 END, 6) AS tnr,
  round((tp + tn) / (tn + fp + fn + tp) * 100.0e0, 6) AS accuracy FROM cm)"""


def cross_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = cl.with_target(clean_flows(spark, sf_dir))
    for token in flow_files.CROSS_EVAL_EXCLUDE:
        flows = flows.where(~F.contains(F.lower("source_file"), F.lit(token)))
    once = fx.scores(spark, sf_dir).select("row_id", "p1", "p2").distinct()
    joined = cl.align_xy(flows.select("row_id", "source_file", "y"), once)
    return rounded(me.cross_dataset_eval(ca.cascade_threshold(joined)))


@check("cross_dataset_eval", f"WITH {CROSS_TABLE} SELECT * FROM cross_table")
def cross_dataset_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_table(spark, sf_dir)


@check("metrics_sink", f"WITH {CROSS_TABLE} SELECT *, 0.5e0 AS threshold_1, 0.5e0 AS threshold_2 FROM cross_table")
def metrics_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    write_metrics(cross_table(spark, sf_dir), path, 0.5, 0.5)
    return load_table(spark, path)


@check("model_comparison", f"""
WITH {WITH_RATES} SELECT model, tn, fp, fn, tp, round(recall, 6) AS recall, round(tnr, 6) AS tnr, round(fpr, 6) AS fpr,
  round(accuracy, 6) AS accuracy, round({_bayes_sql('0.001e0')}, 6) AS bayes_01, round({_bayes_sql('0.05e0')}, 6) AS bayes_50 FROM rated""")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(me.compare_models(long_scored(spark, sf_dir)))


WITH_CURVE = WITH_SCORED + """,
counts AS (SELECT model, proba AS threshold, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
  FROM long GROUP BY model, proba),
running AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY threshold DESC) AS tp, sum(neg) OVER (PARTITION BY model ORDER BY threshold DESC) AS fp,
  sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg FROM counts)"""

_ROC = f"""
WITH {WITH_CURVE} SELECT model, threshold, round(fp / n_neg, 6) AS fpr, round(tp / n_pos, 6) AS tpr FROM running
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0e0, 0.0e0 FROM running"""


@check("roc_curve", _ROC)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cu.roc_curve(long_scored(spark, sf_dir), ["model"]), only=["fpr", "tpr"])


@check("roc_curve_partitioned", _ROC)
def roc_curve_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route for many distinct scores, forced by a single-task limit of zero."""
    return rounded(cu.roc_curve(long_scored(spark, sf_dir), ["model"], single_task_rows=0), only=["fpr", "tpr"])


@check("roc_auc", f"""
WITH {WITH_CURVE}, pts AS (SELECT model, fp / n_neg AS x, tp / n_pos AS y FROM running UNION ALL SELECT DISTINCT model, 0.0e0, 0.0e0 FROM running),
seg AS (SELECT model, x - lag(x) OVER w AS dx, (y + lag(y) OVER w) / 2 AS h FROM pts WINDOW w AS (PARTITION BY model ORDER BY x, y))
SELECT model, round(sum(dx * h), 6) AS auc FROM seg GROUP BY model""")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cu.roc_auc(long_scored(spark, sf_dir), ["model"]))


@check("pr_curve", f"""
WITH {WITH_CURVE} SELECT model, threshold, round(tp / n_pos, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM running
UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), 0.0e0, 1.0e0 FROM running""")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cu.pr_curve(long_scored(spark, sf_dir), ["model"]), only=["recall", "precision"])


@check("threshold_sweep", f"""
WITH {WITH_CURVE}, t AS (SELECT CAST(range AS INTEGER) AS i, CASE WHEN range = 99 THEN 1.0e0 ELSE 0.0e0 + range * ((1.0e0 - 0.0e0) / 99.0e0) END AS t FROM range(100))
SELECT model, i, round(t, 9) AS threshold,
  round(sum(CASE WHEN threshold >= t THEN pos ELSE 0 END) / sum(pos) * 100.0e0, 6) AS recall,
  round(sum(CASE WHEN threshold >= t THEN 0 ELSE neg END) / sum(neg) * 100.0e0, 6) AS tnr
FROM counts CROSS JOIN t GROUP BY model, i, t""")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = cu.threshold_sweep(long_scored(spark, sf_dir), by=["model"])
    return sweep.withColumns({"threshold": F.round("threshold", 9), "recall": F.round("recall", 6), "tnr": F.round("tnr", 6)})


# ---------------------------------------------------------------- scalar functions

@check("string_fns", f"""
WITH flows AS ({FLOWS}) SELECT label, source_file, {STRIPPED} AS stripped, lower({STRIPPED}) AS lowered,
  lower({STRIPPED}) IN ('benign', '0', 'normal') AS benign, contains(lower(source_file), 'morning') AS morning,
  source_file LIKE '%.csv' AS is_csv, count(*) AS n FROM flows GROUP BY label, source_file""")
def string_fns(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fx.flows(spark, sf_dir).groupBy("label", "source_file").agg(F.count("*").alias("n"))
    text = strip(F.col("label"))
    return counts.select(
        "label", "source_file", text.alias("stripped"), F.lower(text).alias("lowered"),
        (binarize(F.col("label")) == 0).alias("benign"), F.contains(F.lower("source_file"), F.lit("morning")).alias("morning"),
        F.endswith("source_file", F.lit(".csv")).alias("is_csv"), "n")


@check("sigmoid_score", f"SELECT row_id, round(1.0e0 / (1.0e0 + exp(-((p1 - 0.5e0) * 8.0e0))), 9) AS proba FROM ({SCORES})")
def sigmoid_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = (F.col("p1") - 0.5) * 8.0
    return fx.scores(spark, sf_dir).select("row_id", F.round(sigmoid(decision), 9).alias("proba"))


@check("min_proba", f"SELECT row_id, least(p1, p2) AS proba FROM ({SCORES})")
def min_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scores(spark, sf_dir).select("row_id", min_proba(F.col("p1"), F.col("p2")).alias("proba"))


@check("guarded_rate", f"""
WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT})
SELECT {KEY}, win, CASE WHEN flow_duration > 0 THEN round(fwd_len_total / (flow_duration / 1e6), 6) ELSE 0 END AS fwd_bytes_s FROM g""")
def guarded_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf_dir)))
    return flows.select(*FLOW_KEY, "win", F.round(guarded_rate(F.col("fwd_len_total"), F.col("flow_duration")), 6).alias("fwd_bytes_s"))


@check("sensitivity_band", f"""
SELECT p1 AS threshold, round(greatest(0.0e0, least(1.0e0, p1 - 0.05e0)), 9) AS more, round(greatest(0.0e0, least(1.0e0, p1 + 0.05e0)), 9) AS less,
  CASE WHEN p1 < 0.3 THEN 'very high' WHEN p1 < 0.6 THEN 'medium' ELSE 'low' END AS sensitivity, count(*) AS n
FROM ({SCORES}) GROUP BY p1""")
def sensitivity_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds = fx.scores(spark, sf_dir).groupBy(F.col("p1").alias("threshold")).agg(F.count("*").alias("n"))
    t = F.col("threshold")
    return thresholds.select("threshold", F.round(step(t, 1), 9).alias("more"), F.round(step(t, -1), 9).alias("less"),
                             band(t).alias("sensitivity"), "n")


# ---------------------------------------------------------------- cascade and alerts over given scores

_LAYERS = f"SELECT *, CAST(p1 > 0.5 AS INTEGER) AS pred1, CAST(p2 > 0.5 AS INTEGER) AS pred2 FROM ({SCORES})"


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scores(spark, sf_dir).withColumns({
        "pred1": ca.predict_class(F.col("p1")), "pred2": ca.predict_class(F.col("p2"))})


@check("cascade_predict", f"SELECT row_id, CASE WHEN pred1 = 1 THEN pred2 ELSE 0 END AS pred FROM ({_LAYERS})")
def cascade_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_predict(layers(spark, sf_dir)).select("row_id", "pred")


@check("cascade_thresholds", f"SELECT row_id, y, CAST(p1 >= 0.5 AND p2 >= 0.5 AS INTEGER) AS pred FROM ({SCORES})")
def cascade_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_threshold(fx.scores(spark, sf_dir)).select("row_id", "y", "pred")


@check("cascade_proba", f"SELECT row_id, y, least(p1, p2) AS proba FROM ({SCORES})")
def cascade_proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_proba(fx.scores(spark, sf_dir)).select("row_id", "y", "proba")


@check("cascade_detailed", f"""
SELECT row_id, CASE WHEN pred1 = 1 AND pred2 = 1 THEN 1 WHEN anomaly = 1 THEN 2 ELSE 0 END AS verdict FROM ({_LAYERS})""")
def cascade_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_detailed(layers(spark, sf_dir)).select("row_id", "verdict")


@check("anomaly_optional", f"SELECT row_id, CASE WHEN pred1 = 1 THEN pred2 ELSE 0 END AS verdict FROM ({_LAYERS})")
def anomaly_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ca.cascade_detailed(layers(spark, sf_dir), anomaly=None).select("row_id", "verdict")


# A stand-in score on assembled flows: the share of forward packets.
_ALERT_SQL = f"""
WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT}),
e AS (SELECT {KEY}, win, src_ip, dst_ip, src_port, dst_port FROM i WHERE in_window = 10 AND ord % 10 = 0)
SELECT src_ip, src_port, dst_ip, dst_port, proto, fwd_packets / 10.0e0 AS proba, {{t}} AS threshold, flow_duration, fwd_packets, bwd_packets
FROM g JOIN e USING ({KEY}, win) WHERE fwd_packets / 10.0e0 >= {{t}}"""


def forward_share(flows: DataFrame) -> DataFrame:
    return flows.withColumn("proba", F.col("fwd_packets") / F.lit(10.0))


@check("alerts", _ALERT_SQL.format(t="0.5e0"))
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf_dir)), endpoints=True)
    scored_flows, _ = al.score_flows(flows, forward_share)
    return al.alerts(scored_flows)
