"""Check queries that fit or stream. One training run per application and input folder serves all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..models import registry
from ..models.ada import AdaBoost
from ..models.forest import ExtraTrees, IsolationForest, Nodes, average_path
from ..models.linear_svm import LinearSvm
from ..models.trees import DecisionTree, GradientBoosting, NewtonBoosting
from ..operators import flows as fl
from ..schema import ALERT_THRESHOLD, FEATURES, FLOW_KEY, TRAIN_FILE_CAP
from ..session import compile_small_methods, scratch_path
from ..sources import flows as flow_files
from ..sources import read_packets
from ..sources.packets import write_packets
from ..streaming.flows import alert_batch, alert_stream, flow_job, flow_stream, set_threshold
from . import evaluation as ev
from . import training as tr
from .catalog import (
    CONFUSION, F32, FAMILY, RATES, REPORT_LINES, _bayes_sql, FLOW_OUTPUT, FLOW_SELECT, KEY, SCALER_STATS, TARGET, WITH_CLEAN, WITH_KEYED, WITH_WINDOWS, _ALERT_SQL, check, distinct_flows,
    forward_share, rounded, sql_draw,
)

ROW = ["row_id", "copy"]          # identifies a fixture row before duplicates are dropped
_RUNS: dict[tuple[str, str, int | None], tr.TrainingRun] = {}


def training_run(spark: SparkSession, sf_dir: str, file_cap: int = TRAIN_FILE_CAP) -> tr.TrainingRun:
    compile_small_methods(spark)
    key = (spark.sparkContext.applicationId, sf_dir, file_cap)
    if key not in _RUNS:
        if file_cap == TRAIN_FILE_CAP:
            _RUNS[key] = tr.TrainingRun(tr.training_rows(fx.flows(spark, sf_dir), ("copy",)))
        else:                              # the same distinct rows and test rows, another training side
            whole = training_run(spark, sf_dir)
            _RUNS[key] = tr.TrainingRun(whole.rows, file_cap=file_cap)
    return _RUNS[key]


def whole_run(spark: SparkSession, sf_dir: str) -> tr.TrainingRun:
    """The same distinct rows and test rows; models are fitted on all others, balanced but not capped."""
    key = (spark.sparkContext.applicationId, sf_dir, None)
    if key not in _RUNS:
        _RUNS[key] = tr.TrainingRun(training_run(spark, sf_dir).rows, cap=None, file_cap=None)
    return _RUNS[key]


def all_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct clean flow, scaled, with its target: what the single-model queries score."""
    return training_run(spark, sf_dir).scaled


# Training as SQL: distinct rows, scaler, 80/20 split, then the training side's per-source cap, 1:1 balance and cap.
WITH_TRAIN = WITH_CLEAN + f""",
narrow AS (SELECT row_id, source_file, {TARGET} AS y, {F32} FROM (SELECT DISTINCT * EXCLUDE (copy) FROM clean)),
scaler AS (SELECT {SCALER_STATS} FROM narrow),
scaled AS (SELECT row_id, source_file, y, {", ".join(f"(t.{f} - s.m_{f}) / s.s_{f} AS {f}" for f in FEATURES)} FROM narrow t CROSS JOIN scaler s),
split AS (SELECT *, row_number() OVER (ORDER BY {sql_draw('row_id', step='split')}) <= ceil(0.2 * (SELECT count(*) FROM scaled)) AS is_test FROM scaled),
thinned AS (SELECT * EXCLUDE (rn, source_file) FROM (SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {sql_draw('row_id', step='source')}) AS rn FROM split WHERE NOT is_test)
  WHERE rn <= {TRAIN_FILE_CAP}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {sql_draw('row_id', step='balance')}) AS rn FROM thinned),
balanced AS (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY y ORDER BY {sql_draw('row_id', step='cap')}) AS rn2 FROM ranked
  WHERE y = 1 OR rn <= (SELECT count(*) FROM ranked WHERE y = 1)),
fitted AS (SELECT * EXCLUDE (rn2) FROM balanced WHERE rn2 <= 20000 OR (SELECT count(*) FROM balanced) <= 40000)"""
SMALL_CAP = 300         # rows per source that are fewer than every source has, also at the smallest scale


def _capped(sql: str) -> str:
    """The same query with `SMALL_CAP` rows per source to fit on."""
    return sql.replace(f"WHERE rn <= {TRAIN_FILE_CAP})", f"WHERE rn <= {SMALL_CAP})")


_TRAINING_SET = f"""WITH {WITH_TRAIN},
used AS (SELECT * FROM fitted UNION ALL SELECT * EXCLUDE (source_file) FROM split WHERE is_test)
SELECT row_id, y, is_test, round(flow_bytes_s, 6) AS flow_bytes_s, round(fwd_packets, 6) AS fwd_packets FROM used"""


@check("training_set_capped", _capped(_TRAINING_SET))
def training_set_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap per source that bites thins the training side; every test row stays."""
    return training_set(spark, sf_dir, SMALL_CAP)


@check("training_set", _TRAINING_SET)
def training_set(spark: SparkSession, sf_dir: str, file_cap: int = TRAIN_FILE_CAP) -> DataFrame:
    """The whole preparation in one result: which rows train, which test, in scaled units."""
    run = training_run(spark, sf_dir, file_cap)
    used = run.train.withColumn("is_test", F.lit(False)).unionByName(run.test.withColumn("is_test", F.lit(True)))
    return rounded(used.select("row_id", "y", "is_test", "flow_bytes_s", "fwd_packets"))


# ---------------------------------------------------------------- single models, scored on every distinct flow

def _scored(code: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = training_run(spark, sf_dir).model(code)
        return model.score(all_scaled(spark, sf_dir)).select("row_id", "y", "proba", "pred")
    return query


def _nb_side(y: int) -> str:
    terms = " - ".join(f"pow(t.{f} - nbc.m{y}_{f}, 2) / (2.0e0 * (nbc.v{y}_{f} + 1e-9 * nbc.widest))" for f in FEATURES)
    logs = " + ".join(f"ln(2.0e0 * pi() * (nbc.v{y}_{f} + 1e-9 * nbc.widest))" for f in FEATURES)
    return f"ln(nbc.n{y} / (nbc.n0 + nbc.n1)) - 0.5e0 * ({logs}) - {terms}"


_NB_STATS = ", ".join(
    f"avg({f}) FILTER (WHERE y = {y}) AS m{y}_{f}, var_pop({f}) FILTER (WHERE y = {y}) AS v{y}_{f}" for f in FEATURES for y in (0, 1))
WITH_NB = WITH_TRAIN + f""",
nbc AS (SELECT {_NB_STATS}, count(*) FILTER (WHERE y = 0) AS n0, count(*) FILTER (WHERE y = 1) AS n1,
  greatest({", ".join(f"var_pop({f})" for f in FEATURES)}) AS widest FROM fitted)"""


def _nb_scores(rows: str, keep: str = "row_id, y", scaled: bool = False, missing: tuple[str, ...] = ()) -> str:
    """WITH parts that score ``rows`` (raw unless ``scaled``) by naive Bayes as ``p``; missing features count as 0."""
    raw = ", ".join(f"0.0e0 AS {f}" if f in missing else f"CASE WHEN {f} = floor({f}) THEN {f} ELSE CAST(CAST({f} AS FLOAT) AS DOUBLE) END AS {f}" for f in FEATURES)
    every = (f"every AS (SELECT {keep}, {', '.join(FEATURES)} FROM ({rows}))" if scaled else
             f"fine AS (SELECT {keep}, {raw} FROM ({rows})), every AS (SELECT {keep}, "
             + ", ".join(f"(t.{f} - s.m_{f}) / s.s_{f} AS {f}" for f in FEATURES) + " FROM fine t CROSS JOIN scaler s)")
    return f"""{WITH_NB}, {every},
joint AS (SELECT {keep}, {_nb_side(0)} AS j0, {_nb_side(1)} AS j1 FROM every t CROSS JOIN nbc),
p AS (SELECT {keep}, 1.0e0 / (1.0e0 + exp(-greatest(least(j1 - j0, 700.0e0), -700.0e0))) AS proba FROM joint)"""


_ROWS_Y = f"SELECT *, {TARGET} AS y FROM (SELECT DISTINCT * EXCLUDE (copy) FROM clean)"
_CLEAN_Y = f"SELECT *, {TARGET} AS y FROM clean"
_NB_SQL = f"""
WITH {_nb_scores(_ROWS_Y)}
SELECT row_id, y, round(proba, 5) AS proba, CAST(proba > 0.5 AS INTEGER) AS pred FROM p"""
_NB_LONG = ", long AS (SELECT 'nb' AS model, y, CAST(proba > 0.5 AS INTEGER) AS pred, proba FROM p)"
_NB_TEST = _nb_scores("SELECT * FROM split WHERE is_test", scaled=True) + _NB_LONG
_NB_ALL = _nb_scores(_CLEAN_Y, keep="y") + _NB_LONG
_RATED = f", cm AS (SELECT model, {CONFUSION} FROM long GROUP BY model), rated AS (SELECT *, {RATES} FROM cm)"
_QUALITY = f"""round(recall, 6) AS recall, round(tnr, 6) AS tnr, round(fpr, 6) AS fpr, round(accuracy, 6) AS accuracy,
  round({_bayes_sql('0.001e0')}, 6) AS bayes_01, round({_bayes_sql('0.05e0')}, 6) AS bayes_50"""

for _code in registry.CODES:
    if _code != "nb":
        check(f"model_{_code}")(_scored(_code))


@check("model_nb", _NB_SQL)
def model_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored("nb")(spark, sf_dir), 5)


# ---------------------------------------------------------------- first steps of fitted trees, which SQL can state

_VALUES = f"[{', '.join(FEATURES)}]"


def _boundaries(rows: str, sums: dict[str, str], worth: str, prefix: str, tie: str = "1e-12") -> str:
    """WITH parts: per feature and boundary the ``sums`` left of it (l_*) and in all (t_*), and the best boundary by ``worth``."""
    added = ", ".join(f"sum({e}) AS {k}" for k, e in sums.items())
    left = ", ".join(f"sum({k}) OVER (PARTITION BY f ORDER BY v) AS l_{k}, sum({k}) OVER (PARTITION BY f) AS t_{k}" for k in sums)
    return f"""{prefix}_long AS (SELECT * EXCLUDE (vs), vs[f + 1] AS v FROM (SELECT *, {_VALUES} AS vs, unnest(range({len(FEATURES)})) AS f FROM {rows})),
{prefix}_sums AS (SELECT f, v, count(*)::DOUBLE AS n, {added} FROM {prefix}_long GROUP BY f, v),
{prefix}_left AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS w, sum(n) OVER (PARTITION BY f ORDER BY v) AS l_n, sum(n) OVER (PARTITION BY f) AS t_n,
  count(*) OVER (PARTITION BY f) AS d, n, {left} FROM {prefix}_sums),
{prefix}_worth AS (SELECT *, CASE WHEN v / 2 + w / 2 >= w OR v / 2 + w / 2 < v THEN v ELSE v / 2 + w / 2 END AS cut, {worth} AS worth FROM {prefix}_left WHERE w IS NOT NULL),
{prefix} AS (SELECT * FROM {prefix}_worth WHERE worth >= (SELECT max(worth) - {tie} * abs(max(worth)) FROM {prefix}_worth) ORDER BY f, cut LIMIT 1)"""


_EVERY = _nb_scores(_ROWS_Y).split(",\njoint AS")[0]            # all distinct rows, scaled
_GINI = """(l_w0 * l_w0 + l_w1 * l_w1) / (l_w0 + l_w1) + ((t_w0 - l_w0) * (t_w0 - l_w0) + (t_w1 - l_w1) * (t_w1 - l_w1)) / (t_w0 + t_w1 - l_w0 - l_w1)"""
_CLASSES = {"w0": "CASE WHEN y = 0 THEN 1.0e0 ELSE 0 END", "w1": "CASE WHEN y = 1 THEN 1.0e0 ELSE 0 END"}
_LEAFS = "CASE WHEN {vs}[b.f + 1] <= b.cut THEN {left} ELSE {right} END"


def _fitted_query(fit):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = fit(training_run(spark, sf_dir).train).score(all_scaled(spark, sf_dir))
        return rounded(scored.select("row_id", "y", "proba", "pred"), 5)
    return query


def _answers(proba: str, more: str = "") -> str:
    return f"""SELECT row_id, y, round(proba, 5) AS proba, CAST(proba > 0.5 AS INTEGER) AS pred FROM (SELECT row_id, y, {proba} AS proba FROM every CROSS JOIN {more})"""


# one level of the exact tree
check("model_dt_stump", f"WITH {_EVERY}, {_boundaries('fitted', _CLASSES, _GINI, 'b')} "
      + _answers(_LEAFS.format(vs=_VALUES, left="l_w1 / (l_w0 + l_w1)", right="(t_w1 - l_w1) / (t_w0 + t_w1 - l_w0 - l_w1)"), "b"))(
    _fitted_query(lambda train: DecisionTree.fit(train, depth=1)))


def _stump_parts(b: str) -> str:
    return f"""{b}s AS (SELECT f, cut, CASE WHEN l_w1 > l_w0 THEN 1 ELSE 0 END AS lo, CASE WHEN t_w1 - l_w1 > t_w0 - l_w0 THEN 1 ELSE 0 END AS hi,
  (least(l_w0, l_w1) + least(t_w0 - l_w0, t_w1 - l_w1)) / (t_w0 + t_w1) AS error FROM {b}),
{b}a AS (SELECT *, ln((1 - error) / error) AS alpha FROM {b}s)"""


# two rounds of discrete boosting
_ADA_SIDE = "CASE WHEN {vs}[{a}.f + 1] <= {a}.cut THEN {a}.lo ELSE {a}.hi END"
_ADA = f"""WITH {_EVERY}, {_boundaries('fitted', _CLASSES, _GINI, 'b')}, {_stump_parts('b')},
again AS (SELECT t.*, exp(CASE WHEN {_ADA_SIDE.format(vs=_VALUES, a='ba')} <> y THEN ba.alpha ELSE 0 END) AS weight FROM fitted t CROSS JOIN ba),
{_boundaries('again', {"w0": "CASE WHEN y = 0 THEN weight ELSE 0 END", "w1": "CASE WHEN y = 1 THEN weight ELSE 0 END"}, _GINI, 'c')}, {_stump_parts('c')}
""" + _answers(f"1 / (1 + exp(-2 * (ba.alpha * (2 * ({_ADA_SIDE.format(vs=_VALUES, a='ba')}) - 1) + ca.alpha * (2 * ({_ADA_SIDE.format(vs=_VALUES, a='ca')}) - 1)) / (ba.alpha + ca.alpha)))", "ba CROSS JOIN ca")
check("model_ada_two", _ADA)(_fitted_query(lambda train: AdaBoost.fit(train, rounds=2)))

# first tree of gradient boosting, one level: residuals, variance, a Newton step per leaf
_GB = f"""WITH {_EVERY}, prior AS (SELECT avg(y) AS p FROM fitted), residuals AS (SELECT t.*, y - p AS r FROM fitted t CROSS JOIN prior),
{_boundaries('residuals', {"r": "r"}, "l_r * l_r / l_n + (t_r - l_r) * (t_r - l_r) / (t_n - l_n)", 'b')}
""" + _answers(f"1 / (1 + exp(-(ln(p / (1 - p)) + 0.1e0 * ({_LEAFS.format(vs=_VALUES, left='l_r / (l_n * p * (1 - p))', right='(t_r - l_r) / ((t_n - l_n) * p * (1 - p))')}))))", "b CROSS JOIN prior")
check("model_gb_first", _GB)(_fitted_query(lambda train: GradientBoosting.fit(train, rounds=1, depth=1)))

# first tree of second-order boosting, one level: 256 bins of equal weight, L2 penalty 1, at least 1 hessian a side
_SIDE = "({g}) * ({g}) / ({n} * h + 1)"
_XGB_WORTH = f"""CASE WHEN l_n * h >= 1 AND (t_n - l_n) * h >= 1 AND (d <= 256 OR (l_n * 256)::BIGINT // t_n::BIGINT > ((l_n - n) * 256)::BIGINT // t_n::BIGINT)
  THEN {_SIDE.format(g='l_g', n='l_n')} + {_SIDE.format(g='t_g - l_g', n='(t_n - l_n)')} - {_SIDE.format(g='t_g', n='t_n')} ELSE -1 END"""
_XGB_BOUNDS = _boundaries('gradients', {"g": "p - y"}, _XGB_WORTH, 'b', "1e-9").replace("count(*)::DOUBLE AS n,", "count(*)::DOUBLE AS n, any_value(h) AS h,").replace("AS d, n,", "AS d, n, h,")
_XGB = f"""WITH {_EVERY}, start AS (SELECT 4 * (avg(y) - 0.5e0) AS m, 1 / (1 + exp(-4 * (avg(y) - 0.5e0))) AS p FROM fitted),
gradients AS (SELECT t.*, p, p * (1 - p) AS h FROM fitted t CROSS JOIN start), {_XGB_BOUNDS}
""" + _answers(f"1 / (1 + exp(-(m + 0.1e0 * (CASE WHEN {_VALUES}[b.f + 1] < b.w THEN -l_g / (l_n * h + 1) ELSE -(t_g - l_g) / ((t_n - l_n) * h + 1) END))))", "b CROSS JOIN start")
check("model_xgb_first", _XGB)(_fitted_query(lambda train: NewtonBoosting.fit(train, rounds=1, depth=1)))


# nearest neighbours of every test row among a small training set
_APART = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in FEATURES)


@check("model_knn_capped", _capped(f"""WITH {WITH_TRAIN},
near AS (SELECT a.row_id, a.y, b.y AS vote FROM split a CROSS JOIN fitted b WHERE a.is_test
  QUALIFY row_number() OVER (PARTITION BY a.row_id ORDER BY {_APART}, b.row_id) <= 5)
SELECT row_id, any_value(y) AS y, round(avg(vote), 5) AS proba, CAST(avg(vote) > 0.5 AS INTEGER) AS pred FROM near GROUP BY row_id"""))
def model_knn_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training_run(spark, sf_dir, SMALL_CAP)
    return rounded(run.model("knn").score(run.test).select("row_id", "y", "proba", "pred"), 5)


@check("model_iforest")
def model_iforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(registry.ANOMALY)(spark, sf_dir)


@check("model_store", _NB_SQL)
def model_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaler and naive Bayes saved, loaded and used: the scores must be those of the model in memory."""
    run = training_run(spark, sf_dir)
    folder = scratch_path(spark, "models")
    run.model("nb")
    run.save(spark, folder)
    saved = tr.SavedRun(spark, folder)
    scaled = saved.transform(distinct_flows(spark, sf_dir), keep=("row_id", "y"))
    return rounded(saved.model("nb").score(scaled).select("row_id", "y", "proba", "pred"), 5)


@check("depth_study")
def depth_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training_run(spark, sf_dir)
    return tr.depth_study(run.train, run.test)


@check("train_all")
def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models, fitted on every training row, on every test row."""
    return tr.compare_on_test(whole_run(spark, sf_dir), registry.CODES)


@check("train_report")
def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.report_on_test(training_run(spark, sf_dir), registry.CODES)


@check("evaluate_external")
def evaluate_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.evaluate_external(training_run(spark, sf_dir), fx.flows(spark, sf_dir))


@check("evaluate_unlabelled")
def evaluate_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No label column and two features missing: prediction mix only."""
    flows = fx.flows(spark, sf_dir).drop("label", "flow_iat_max", "bwd_len_min")
    return ev.evaluate_external(training_run(spark, sf_dir), flows)


@check("decision_grid")
def decision_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training_run(spark, sf_dir)
    return ev.decision_grid(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW))


# ---------------------------------------------------------------- the same jobs with naive Bayes, which SQL can state

@check("train_all_nb", f"WITH {_NB_TEST}{_RATED} SELECT model, tn, fp, fn, tp, {_QUALITY} FROM rated")
def train_all_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged on every test row of all distinct rows."""
    return rounded(tr.compare_on_test(training_run(spark, sf_dir), ["nb"], anomaly=False))


@check("train_all_nb_capped", _capped(f"WITH {_NB_TEST}{_RATED} SELECT model, tn, fp, fn, tp, {_QUALITY} FROM rated"))
def train_all_nb_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on few rows of each source, judged on the same test rows: a fifth of all distinct rows."""
    return rounded(tr.compare_on_test(training_run(spark, sf_dir, SMALL_CAP), ["nb"], anomaly=False))


@check("train_report_nb_capped", _capped(f"WITH {_NB_TEST}, {REPORT_LINES}"))
def train_report_nb_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tr.report_on_test(training_run(spark, sf_dir, SMALL_CAP), ["nb"], anomaly=False))


@check("train_report_nb", f"WITH {_NB_TEST}, {REPORT_LINES}")
def train_report_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tr.report_on_test(training_run(spark, sf_dir), ["nb"], anomaly=False))


@check("evaluate_external_nb", f"""WITH {_NB_ALL}{_RATED} SELECT model, tn, fp, fn, tp, {_QUALITY}, tn + fp + fn + tp AS total,
  tn + fn AS benign, fp + tp AS attack, round((fp + tp) / (tn + fp + fn + tp) * 100.0e0, 6) AS attack_pct FROM rated""")
def evaluate_external_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.evaluate_external(training_run(spark, sf_dir), fx.flows(spark, sf_dir), ["nb"]))


_NB_FILES = _nb_scores(_CLEAN_Y, keep="source_file, y") + ", cm AS (SELECT source_file, 'nb' AS model, " + CONFUSION + \
    " FROM (SELECT source_file, y, CAST(proba > 0.5 AS INTEGER) AS pred FROM p) GROUP BY source_file)"


@check("evaluate_files_nb", f"""WITH {_NB_FILES}, rated AS (SELECT *, {RATES} FROM cm) SELECT source_file, model, tn, fp, fn, tp, {_QUALITY}, tn + fp + fn + tp AS total,
  tn + fn AS benign, fp + tp AS attack, round((fp + tp) / (tn + fp + fn + tp) * 100.0e0, 6) AS attack_pct FROM rated""")
def evaluate_files_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every external file judged by itself, in one pass."""
    return rounded(ev.evaluate_external(training_run(spark, sf_dir), fx.flows(spark, sf_dir), ["nb"], by=["source_file"]))


_LOST = ("flow_iat_max", "bwd_len_min")
_REST = " AND ".join(f"{f} IS NOT NULL AND isfinite({f})" for f in FEATURES if f not in _LOST)


@check("evaluate_unlabelled_nb", f"""WITH {_nb_scores(f"SELECT * FROM flows WHERE {_REST}", keep="row_id", missing=_LOST)}
SELECT 'nb' AS model, count(*) AS total, count(*) FILTER (WHERE proba <= 0.5) AS benign, count(*) FILTER (WHERE proba > 0.5) AS attack,
  round(count(*) FILTER (WHERE proba > 0.5) / count(*) * 100.0e0, 6) AS attack_pct FROM p""")
def evaluate_unlabelled_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No label column and two features missing, which count as 0: how many rows are called what."""
    flows = fx.flows(spark, sf_dir).drop("label", *_LOST)
    return rounded(ev.evaluate_external(training_run(spark, sf_dir), flows, ["nb"]))


@check("external_reports_nb", f"WITH {_NB_ALL}, {REPORT_LINES}")
def external_reports_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.external_reports(training_run(spark, sf_dir), fx.flows(spark, sf_dir), ["nb"]))


@check("availability_quality_nb", f"WITH {_NB_ALL}{_RATED} SELECT model, tn, fp, fn, tp, {_QUALITY} FROM rated")
def availability_quality_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All clean rows of the source."""
    run = training_run(spark, sf_dir)
    return rounded(ev.availability_report(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW), ["nb"], parts=("quality",))["quality"])


@check("cascade_models_nb", f"""WITH {_nb_scores(_ROWS_Y)}
SELECT row_id, y, round(proba, 5) AS p1, CAST(proba > 0.5 AS INTEGER) AS pred, CAST(proba > 0.5 AS INTEGER) AS verdict FROM p""")
def cascade_models_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes as both layers, without the anomaly layer."""
    scored = ev.cascade_scores(training_run(spark, sf_dir), all_scaled(spark, sf_dir), ("nb", "nb"), anomaly=False)
    return rounded(scored.select("row_id", "y", "p1", "pred", "verdict"), 5)


@check("cascade_single_report_nb", f"WITH {_NB_ALL}{_RATED} SELECT tn, fp, fn, tp, {_QUALITY} FROM rated")
def cascade_single_report_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training_run(spark, sf_dir)
    return rounded(ev.cascade_report(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW), ("nb", "nb"), parts=("quality",))["quality"])


_NB_SOURCES = _nb_scores(_CLEAN_Y + " WHERE NOT contains(lower(source_file), 'monday') AND NOT contains(lower(source_file), 'mock')", keep="source_file, y")


@check("cascade_cross_report_nb", f"""WITH {_NB_SOURCES},
sourced AS (SELECT source_file, y, CAST(proba >= 0.5 AS INTEGER) AS pred FROM p), cm AS (SELECT source_file, {CONFUSION} FROM sourced GROUP BY source_file)
SELECT source_file, {FAMILY} AS attack_type, tn + fp + fn + tp AS samples, tn + fp AS benign, tp + fn AS attack,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) * 100.0e0 ELSE 0 END, 6) AS recall,
  round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) * 100.0e0 ELSE 100 END, 6) AS tnr,
  round((tp + tn) / (tn + fp + fn + tp) * 100.0e0, 6) AS accuracy FROM cm""")
def cascade_cross_report_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clean row of every source."""
    flows = fx.flows(spark, sf_dir)
    for token in flow_files.CROSS_EVAL_EXCLUDE:
        flows = flows.where(~F.contains(F.lower("source_file"), F.lit(token)))
    return rounded(ev.cross_source_report(training_run(spark, sf_dir), flows, ROW, layers=("nb", "nb")))


_GRID_POINT = {"flow_duration": ("xl", "xh", "cell % 40"), "fwd_len_max": ("yl", "yh", "cell // 40")}
_GRID_ROWS = """SELECT *, CAST(cell % 40 AS INTEGER) AS ix, CAST(cell // 40 AS INTEGER) AS iy, flow_duration AS x, fwd_len_max AS y FROM (SELECT cell, """ + ", ".join(
    "CASE WHEN {2} = 39 THEN {1} ELSE {0} + ({2}) * (({1} - {0}) / 39.0e0) END AS {3}".format(*_GRID_POINT[f], f) if f in _GRID_POINT else f for f in FEATURES) + """
  FROM (SELECT min(flow_duration) AS xl, max(flow_duration) AS xh, min(fwd_len_max) AS yl, max(fwd_len_max) AS yh, """ + ", ".join(
    f"avg({f}) AS {f}" for f in FEATURES if f not in _GRID_POINT) + """ FROM clean) CROSS JOIN (SELECT CAST(range AS INTEGER) AS cell FROM range(1600)))"""


@check("decision_grid_nb", f"""WITH {_nb_scores(_GRID_ROWS, keep="cell, ix, iy, x, y")}
SELECT cell, ix, iy, round(x, 2) AS x, round(y, 2) AS y, 'nb' AS model, CAST(proba > 0.5 AS INTEGER) AS pred FROM p""")
def decision_grid_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each point of the grid over two features of all clean rows."""
    run = training_run(spark, sf_dir)
    return rounded(ev.decision_grid(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW), ["nb"]), 2)


_WEIGHTS = [round((i % 5 - 2) * 0.3, 1) for i in range(len(FEATURES))]
_DECISION = " + ".join(f"{w!r}e0 * {f}" for w, f in zip(_WEIGHTS, FEATURES, strict=True)) + " - 0.1e0"


@check("svm_given", f"""WITH {_nb_scores(_ROWS_Y).split(",\njoint AS")[0]}, s AS (SELECT row_id, y, {_DECISION} AS d FROM every)
SELECT row_id, y, round(1.0e0 / (1.0e0 + exp(-greatest(least(d, 700.0e0), -700.0e0))), 5) AS proba, CAST(d > 0 AS INTEGER) AS pred FROM s""")
def svm_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A linear machine of given weights on every distinct flow."""
    model = LinearSvm({"weights": _WEIGHTS, "bias": -0.1})
    return rounded(model.score(all_scaled(spark, sf_dir)).select("row_id", "y", "proba", "pred"), 5)


# ---------------------------------------------------------------- the cascade's own kinds of layers with given parameters

_STUMPS = [{"feature": 0, "cut": -0.2, "left": 1, "right": 0, "alpha": 0.9}, {"feature": 12, "cut": -0.05, "left": 0, "right": 1, "alpha": 0.4}]
#: Two trees in one node table: (feature or -1, cut, left child, leaf value); the right child follows the left one.
_TREES = [(3, 0.0, 1, 0.0), (-1, 0.0, 0, 0.2), (11, -0.1, 3, 0.0), (-1, 0.0, 0, 0.9), (-1, 0.0, 0, 0.4), (7, -0.3, 6, 0.0), (-1, 0.0, 0, 0.1), (-1, 0.0, 0, 0.8)]
_PATHS = [(f, c, left, 3.0 * v + 1.0) for f, c, left, v in _TREES]
_SAMPLE, _CUTOFF = 16, 0.68


def _tree_sql(table: list[tuple], at: int) -> str:
    f, cut, left, value = table[at]
    return f"{value!r}e0" if f < 0 else f"CASE WHEN {FEATURES[f]} <= {cut!r}e0 THEN {_tree_sql(table, left)} ELSE {_tree_sql(table, left + 1)} END"


_VOTE = " + ".join(f"{s['alpha']}e0 * CASE WHEN {FEATURES[s['feature']]} <= {s['cut']}e0 THEN {2 * s['left'] - 1} ELSE {2 * s['right'] - 1} END" for s in _STUMPS)


@check("cascade_given", f"""WITH {_nb_scores(_ROWS_Y).split(",\njoint AS")[0]},
s AS (SELECT row_id, y, 1 / (1 + exp(-2 * ({_VOTE}) / {sum(s['alpha'] for s in _STUMPS)}e0)) AS p1, ({_tree_sql(_TREES, 0)} + {_tree_sql(_TREES, 5)}) / 2 AS p2,
  pow(2.0e0, -(({_tree_sql(_PATHS, 0)} + {_tree_sql(_PATHS, 5)}) / 2) / {float(average_path(_SAMPLE))!r}e0) AS odd FROM every)
SELECT row_id, y, round(p1, 5) AS p1, round(p2, 5) AS p2, round(least(p1, p2), 5) AS proba, CAST(p1 > 0.5 AND p2 > 0.5 AS INTEGER) AS pred,
  CASE WHEN p1 > 0.5 AND p2 > 0.5 THEN 1 WHEN odd > {_CUTOFF} THEN 2 ELSE 0 END AS verdict FROM s""")
def cascade_given(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stumps, a forest of two trees and an isolation forest of two trees, all given, as the three layers."""
    run = tr.TrainingRun(training_run(spark, sf_dir).rows)
    nodes = lambda table: Nodes(*zip(*table, strict=True), roots=[0, 5])
    run.models = {"ada": AdaBoost({"stumps": _STUMPS}), "et": ExtraTrees(nodes(_TREES)), "iforest": IsolationForest(nodes(_PATHS), _SAMPLE, _CUTOFF)}
    scored = ev.cascade_scores(run, all_scaled(spark, sf_dir))
    return rounded(scored.select("row_id", "y", "p1", "p2", "proba", "pred", "verdict"), 5)


# ---------------------------------------------------------------- the fitted cascade

@check("cascade_models")
def cascade_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AdaBoost, Extra Trees and isolation forest on every distinct flow."""
    scored = ev.cascade_scores(training_run(spark, sf_dir), all_scaled(spark, sf_dir))
    return scored.select("row_id", "y", "p1", "p2", "pred", "proba", "verdict")


@check("cascade_cross_report")
def cascade_cross_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = fx.flows(spark, sf_dir)
    for token in flow_files.CROSS_EVAL_EXCLUDE:
        flows = flows.where(~F.contains(F.lower("source_file"), F.lit(token)))
    return ev.cross_source_report(training_run(spark, sf_dir), flows, ROW)


@check("cascade_single_report")
def cascade_single_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = training_run(spark, sf_dir)
    return ev.cascade_report(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW), parts=("quality",))["quality"]


@check("availability_quality")
def availability_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten models on every clean row of the source."""
    run = training_run(spark, sf_dir)
    return ev.availability_report(run, ev.single_source(run, fx.flows(spark, sf_dir), ROW), parts=("quality",))["quality"]


# ---------------------------------------------------------------- streaming

SLICE_FILES = 4       # files that a slice is written as, and that a micro-batch takes


def _write_slices(spark: SparkSession, sf_dir: str, path: str, numbers: range, slices: int = 4) -> None:
    """Some of ``slices`` groups of files with all packets in time order, so a stream reads them one after another."""
    packets = fx.packets(spark, sf_dir)
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = packets.agg(F.min(us), F.max(us)).first()
    part = F.least(F.floor((us - lo) * slices / F.lit(hi - lo + 1)), F.lit(slices - 1))
    for i in numbers:
        write_packets(packets.where(part == i).repartition(SLICE_FILES), path)


def _packet_slices(spark: SparkSession, sf_dir: str, slices: int = 4) -> str:
    path = scratch_path(spark, "packet-stream")
    _write_slices(spark, sf_dir, path, range(slices), slices)
    return path


def _run_to_table(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Everything the stream yields for the files present, read back from a Parquet sink."""
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    running = (stream.writeStream.format("parquet").outputMode("append").option("path", out)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@check("flow_stream", f"WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT}) {FLOW_OUTPUT}")
def stream_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four micro-batches; the flows must be those of the batch operator."""
    packets = read_packets(spark, _packet_slices(spark, sf_dir), streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    return rounded(_run_to_table(spark, flow_stream(packets)).drop("src_ip", "dst_ip", "src_port", "dst_port"))


@check("flow_stream_carried", f"WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT}) {FLOW_OUTPUT}")
def carried_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the batch operator and a carried table of what waits, one version per micro-batch."""
    base = scratch_path(spark, "carried")
    packets = read_packets(spark, _packet_slices(spark, sf_dir), streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    flow_job(packets, f"{base}/flows", f"{base}/waiting", f"{base}/state", availableNow=True).awaitTermination()
    return rounded(spark.read.parquet(f"{base}/flows").drop("batch", "src_ip", "dst_ip", "src_port", "dst_port"))


@check("idle_eviction", f"""
WITH {WITH_KEYED},
gaps AS (SELECT *, us - lag(us) OVER (PARTITION BY {KEY} ORDER BY us, packet_id) AS gap FROM k),
runs AS (SELECT *, sum(CASE WHEN gap > 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY {KEY} ORDER BY us, packet_id) AS run FROM gaps),
placed AS (SELECT *, (row_number() OVER (PARTITION BY {KEY}, run ORDER BY us, packet_id) - 1) // 10 AS win FROM runs)
SELECT {KEY}, CAST(win AS BIGINT) AS win, max(us) - min(us) AS flow_duration, CAST(sum(fwd) AS BIGINT) AS fwd_packets, CAST(sum(length) AS BIGINT) AS bytes
FROM placed GROUP BY {KEY}, run, win HAVING count(*) = 10""")
def idle_eviction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps of more than a day drop the packets waiting before them; windows are numbered from 0 after each."""
    packets = read_packets(spark, _packet_slices(spark, sf_dir), streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    flows = _run_to_table(spark, flow_stream(packets, idle="24 hours", watermark="1 hour"))
    return flows.select(*FLOW_KEY, "win", "flow_duration", "fwd_packets", (F.col("fwd_len_total") + F.col("bwd_len_total")).alias("bytes"))


@check("live_threshold", _ALERT_SQL.format(t="0.7e0"))
def live_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream whose threshold was raised to 0.7 before it started."""
    packets = read_packets(spark, _packet_slices(spark, sf_dir), streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
    base = scratch_path(spark, "alerts")
    set_threshold(spark, f"{base}/threshold", 0.7)
    alert_stream(flow_stream(packets), forward_share, f"{base}/threshold", f"{base}/alerts", f"{base}/rejected",
                 f"{base}/state", availableNow=True).awaitTermination()
    return spark.read.parquet(f"{base}/alerts").drop("batch")


@check("live_threshold_change", f"""
WITH {WITH_WINDOWS}, g AS ({FLOW_SELECT}), span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM packets),
e AS (SELECT {KEY}, win, max(CASE WHEN ord % 10 = 0 THEN fwd END) = 1 AS opened, max(us) AS us FROM i WHERE in_window = 10 GROUP BY {KEY}, win),
t AS (SELECT *, fwd_packets / 10.0e0 AS proba, CASE WHEN least(floor((us - lo) * 4 / (hi - lo + 1)), 3) <= 1 THEN 0.5e0 ELSE 0.7e0 END AS threshold
      FROM g JOIN e USING ({KEY}, win) CROSS JOIN span)
SELECT CASE WHEN opened THEN ip_a ELSE ip_b END AS src_ip, CASE WHEN opened THEN port_a ELSE port_b END AS src_port,
  CASE WHEN opened THEN ip_b ELSE ip_a END AS dst_ip, CASE WHEN opened THEN port_b ELSE port_a END AS dst_port, proto, proba, threshold,
  flow_duration, fwd_packets, bwd_packets FROM t WHERE proba >= threshold""")
def live_threshold_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose threshold rises from 0.5 to 0.7 between its second and third micro-batch."""
    base, files = scratch_path(spark, "alerts"), scratch_path(spark, "packet-stream")
    for numbers, threshold in ((range(2), 0.5), (range(2, 4), 0.7)):
        _write_slices(spark, sf_dir, files, numbers)
        set_threshold(spark, f"{base}/threshold", threshold)
        packets = read_packets(spark, files, streaming=True, maxFilesPerTrigger=str(SLICE_FILES))
        flow_job(packets, f"{base}/flows", f"{base}/waiting", f"{base}/state", availableNow=True, then=lambda flows, batch_id: alert_batch(
            flows, batch_id, forward_share, f"{base}/threshold", f"{base}/alerts", f"{base}/rejected")).awaitTermination()
    return spark.read.parquet(f"{base}/alerts").drop("batch")


@check("model_alerts")
def model_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assembled flows through the fitted cascade, with the combined probability and whether it alerts."""
    run = training_run(spark, sf_dir)
    flows = fl.flow_features(fl.keyed_packets(fx.packets(spark, sf_dir)), endpoints=True)
    return ev.score_flow_windows(run, flows).select(
        "src_ip", "src_port", "dst_ip", "dst_port", "proto", "win", "proba", (F.col("proba") >= ALERT_THRESHOLD).alias("alert"),
        "flow_duration", "fwd_packets", "bwd_packets")
