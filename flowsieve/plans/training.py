"""From labelled flows to fitted models.

The order matters: clean, drop duplicates, fit the scaler on all distinct rows (so it has seen the test rows too), split
off the test rows, and only then cap each source, balance and cap the training side: models are fitted on a bounded table
and judged on every test row, whatever the caps. Two tables are written on the way: the distinct rows at model precision and
the small training table. Scaled values and test marks follow from a written row by itself, so they are computed when read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..models import registry
from ..models.base import Model, majority, scored_in_python
from ..models.trees import DecisionTree
from ..operators import cleaning as cl
from ..operators import metrics as me
from ..operators import sampling as sa
from ..operators import scaling as sc
from ..schema import DEPTH_STUDY, FEATURES, SEED, TEST_FRACTION, TRAIN_CAP, TRAIN_FILE_CAP
from ..session import materialize
from ..sources.store import load_table, save_table


ROWS_PER_TASK = 5_000


def training_rows(flows: DataFrame, tags: tuple[str, ...] = (), single_precision: bool = True) -> DataFrame:
    """All distinct clean rows with ``row_id``, ``y``, ``source_file`` and the 15 features; ``tags`` are columns that are no data."""
    rows = cl.distinct_by_hash(cl.drop_non_finite(cl.clean_columns(flows)), tags)
    if "row_id" not in rows.columns:
        rows = cl.with_row_id(rows, ignore=tags)
    rows = cl.conform(cl.with_target(rows), strict=True, keep=("row_id", "y", "source_file"))
    return materialize(cl.model_types(rows) if single_precision else rows, "training-rows")


@dataclass
class TrainingRun:
    """A prepared training set; models are fitted when first asked for and then kept."""

    rows: DataFrame
    seed: int = SEED
    ratio: float = 1.0
    cap: int | None = TRAIN_CAP
    fraction: float = TEST_FRACTION
    file_cap: int | None = TRAIN_FILE_CAP
    models: dict[str, Model] = field(default_factory=dict)

    @cached_property
    def scaler(self) -> DataFrame:
        return materialize(sc.scaler_fit(self.rows), "scaler")

    @cached_property
    def params(self) -> dict[str, tuple[float, float]]:
        return sc.scaler_params(self.scaler)

    @cached_property
    def scaled(self) -> DataFrame:
        """All distinct rows, scaled."""
        return sc.scaler_apply(self.rows, self.params)

    @cached_property
    def split(self) -> DataFrame:
        """All distinct rows, scaled, with ``is_test``: a comparison of the row's draw with the cut, which is found once."""
        return sa.mark_test(self.scaled, self.fraction, ["row_id"], self.seed)

    @cached_property
    def train(self) -> DataFrame:
        """Training rows, capped per source where there are several, balanced and capped; a cap of None keeps all rows.

        A small set is packed into few partitions, as every fit passes over it many times.
        """
        left = self.split.where("NOT is_test").drop("is_test")
        if self.file_cap is not None and left.select("source_file").distinct().limit(2).count() > 1:
            left = materialize(sa.sample_n(left, self.file_cap, ["row_id"], by="source_file", seed=f"{self.seed}:source"), "thinned")
        left = left.drop("source_file")
        balanced = sa.undersample(left, ["row_id"], self.ratio, self.seed)
        train = materialize(balanced if self.cap is None else sa.stratified_cap(balanced, self.cap, ["row_id"], self.seed), "balanced")
        wanted = max(1, -(-train.count() // ROWS_PER_TASK))
        return train.coalesce(wanted) if wanted < train.rdd.getNumPartitions() else train

    @property
    def test(self) -> DataFrame:
        """Every distinct row that was split off, neither balanced nor capped."""
        return self.split.where("is_test").drop("is_test", "source_file")

    def holds(self, code: str) -> bool:
        """Whether the model belongs to the run; a run that fits has them all."""
        return True

    def model(self, code: str) -> Model:
        if code not in self.models:
            self.models[code] = (registry.fit_iforest(cl.benign_only(self.train), self.seed) if code == registry.ANOMALY
                                 else registry.fit(code, self.train, self.seed))
        return self.models[code]

    def transform(self, flows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Raw flows to scaled features: clean, fill missing features with 0, narrow, standardise."""
        clean = cl.drop_non_finite(cl.clean_columns(flows))
        return sc.scaler_apply(cl.model_types(cl.conform(clean, keep=keep)), self.params)

    def save(self, spark: SparkSession, folder: str) -> str:
        """Write scaler and models as a new version of the folder's model set; it counts once its manifest line is there."""
        version = f"v-{uuid.uuid4().hex}"
        save_table(self.scaler, f"{folder}/{version}/scaler")
        for model in self.models.values():
            registry.save(model, spark, f"{folder}/{version}")
        publish(spark, folder, version, self.params, sorted(self.models))
        return version


# ---------------------------------------------------------------- saved model sets

MANIFEST = "number long, version string, features array<string>, scaler_hash string, models array<string>"


def scaler_hash(params: dict[str, tuple[float, float]]) -> str:
    return hashlib.sha256(json.dumps([[f, *map(float.hex, params[f])] for f in FEATURES]).encode()).hexdigest()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The published versions of a model set; raises FileNotFoundError when there is none."""
    return load_table(spark, f"{folder}/manifest")


def publish(spark: SparkSession, folder: str, version: str, params: dict[str, tuple[float, float]], models: list[str]) -> None:
    """Append the version's line, which a reader sees whole or not at all, as the last step of saving."""
    try:
        last = manifest(spark, folder).agg(F.max("number")).first()[0]
    except FileNotFoundError:
        last = 0
    line = [(last + 1, version, FEATURES, scaler_hash(params), models)]
    spark.createDataFrame(line, MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


class SavedRun(TrainingRun):
    """Scaler and models of the latest published version of a folder, or of a given one.

    The version is chosen once, so a job that runs on while a new one is saved keeps one consistent set. A set whose features
    or scaler are not those its manifest names is refused.
    """

    def __init__(self, spark: SparkSession, folder: str, version: str | None = None):
        super().__init__(rows=None)
        lines = manifest(spark, folder)
        line = (lines if version is None else lines.where(F.col("version") == version)).orderBy(F.desc("number"), "version").first()
        if line is None:
            raise FileNotFoundError(f"{folder}: no version {version}")
        self.version, self.saved = line["version"], list(line["models"])
        self.scaler = load_table(spark, f"{folder}/{self.version}/scaler")
        if list(line["features"]) != FEATURES or scaler_hash(self.params) != line["scaler_hash"]:
            raise ValueError(f"{folder}/{self.version} was saved for other features or another scaler")
        self._spark, self._folder = spark, f"{folder}/{self.version}"

    def holds(self, code: str) -> bool:
        return code in self.saved

    def model(self, code: str) -> Model:
        if code not in self.models:
            self.models[code] = registry.load(code, self._spark, self._folder)
        return self.models[code]


def available(run: TrainingRun, codes: list[str], skipped: dict[str, str] | None = None) -> dict[str, Model]:
    """The models that the run holds; those a saved set was published without are left out.

    One that is held and fails to fit or load is an error, so no result lacks its lines unnoticed. Only a caller who passes
    ``skipped`` goes on without it, and finds the reason there.
    """
    found = {}
    for code in codes:
        if not run.holds(code):
            if skipped is not None:
                skipped[code] = "not in the saved set"
            continue
        try:
            found[code] = run.model(code)
        except Exception as error:
            if skipped is None:
                raise
            skipped[code] = f"{type(error).__name__}: {str(error)[:500]}"
    return found


def model_status(run: TrainingRun, codes: list[str]) -> DataFrame:
    """One row per model: whether it can be had, and the reason if not."""
    skipped: dict[str, str] = {}
    found = available(run, codes, skipped)
    rows = [(code, code in found, skipped.get(code)) for code in codes]
    return run.split.sparkSession.createDataFrame(rows, "model string, available boolean, reason string")


def score_all(scaled: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``p_<code>`` and ``pred_<code>`` for every model, in one pass over the rows and at most one visit to Python for those that share it."""
    makers = {code: make for code, model in models.items() if (make := model.scorer(scaled.sparkSession)) is not None}
    if makers:                                   # first, as expressions above read the scaled features and do not repeat how they are scaled
        scaled = scored_in_python(scaled, {f"p_{code}": make for code, make in makers.items()})
        scaled = scaled.withColumns({f"pred_{code}": majority(F.col(f"p_{code}")) for code in makers})
    for code, model in models.items():
        if code not in makers:
            scaled = model.score(scaled).withColumnsRenamed({"proba": f"p_{code}", "pred": f"pred_{code}"})
    return scaled


def compare_on_test(run: TrainingRun, codes: list[str], anomaly: bool = True) -> DataFrame:
    """Fit everything and compare on the held-out rows: one line per model, the anomaly model included."""
    models = available(run, [*codes, registry.ANOMALY] if anomaly else codes)
    wide = score_all(run.test, models)
    return me.compare_models(me.class_counts(wide, list(models)), rows="rows")


def report_on_test(run: TrainingRun, codes: list[str], anomaly: bool = True) -> DataFrame:
    """Classification report of each model on the held-out rows, the anomaly model included."""
    models = available(run, [*codes, registry.ANOMALY] if anomaly else codes)
    wide = score_all(run.test, models)
    return me.classification_report(me.confusion(me.class_counts(wide, list(models)), ["model"], "rows"))


def depth_study(train: DataFrame, test: DataFrame, depths: list[int | None] = DEPTH_STUDY, seed: int = SEED) -> DataFrame:
    """Train and test accuracy of a decision tree per depth (None: no limit), and their gap in percentage points.

    Levels of a tree do not depend on those below, so one tree is fitted and cut to each depth.
    """
    deepest = None if None in depths else max(depths)
    whole = DecisionTree.fit(train, seed, deepest)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    lines = None
    for depth in depths:
        scored = whole.cut_to(depth).score(both).select("part", (F.col("y") == F.col("pred")).cast("int").alias("hit"))
        share = lambda part: F.avg(F.when(F.col("part") == part, F.col("hit"))) * 100.0
        line = scored.agg(share("train").alias("train_acc"), share("test").alias("test_acc")).select(
            F.lit(-1 if depth is None else depth).alias("depth"), "train_acc", "test_acc",
            (F.col("train_acc") - F.col("test_acc")).alias("gap"))
        lines = line if lines is None else lines.unionByName(line)
    return lines


