"""The saved model: preprocessing with one or more classifiers, and the thresholds."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.features import MODEL_COLUMNS
from ebbtide.operators import tree_explain
from ebbtide.operators.boosting import BoostedTrees
from ebbtide.operators.models import Classifier, churn_probability, conform, scaled_name
from ebbtide.operators.scoring import DEFAULT_THRESHOLDS, choose_threshold, prediction_table, record_table
from ebbtide.operators.validation import split_valid
from ebbtide.schema import ID, quoted


@dataclass(frozen=True)
class Bundle:
    preprocessing: PipelineModel
    classifiers: tuple[Classifier, ...]  # more than one: their mean probability counts
    thresholds: Mapping[str, float]

    def _with_probability(self, customers: DataFrame) -> DataFrame:
        frame = self.preprocessing.transform(conform(customers))
        names = [f"_p{i}" for i in range(len(self.classifiers))]
        for name, model in zip(names, self.classifiers):
            frame = churn_probability(frame, model, name)
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        return frame.withColumn("_p", total / len(names))

    def score(self, customers: DataFrame, mode: str = "default") -> DataFrame:
        """Batch scoring: read columns, encode, score and band in one narrow pass."""
        return prediction_table(self._with_probability(customers), "_p", choose_threshold(self.thresholds, mode))

    def score_records(self, requests: DataFrame, mode: str = "default") -> DataFrame:
        """Validate and score request records, batch or stream, in the same pass."""
        frame = self._with_probability(split_valid(requests, strict=False))
        return record_table(frame, F.col("_p"), choose_threshold(self.thresholds, mode))

    def contributions(self, customers: DataFrame) -> DataFrame:
        """(member, row, feature, phi): exact Shapley values of every tree model of the bundle for
        raw customer rows, by ``customerID``. Log odds, for a forest probability."""
        frame = self.preprocessing.transform(conform(customers)).select(ID, "features")
        found = [tree_explain.shap_trees(m, frame, MODEL_COLUMNS, ID).select(F.lit(i).alias("member"), "*") for i, m in enumerate(self.classifiers)]
        return reduce(DataFrame.unionByName, found)

    def dependence(self, spark: SparkSession) -> DataFrame:
        """(member, feature, low, high, dependence): partial dependence of every tree model of the
        bundle, its cuts in the units of the unscaled model columns."""
        steps = [
            tree_explain.dependence_steps(m, spark, MODEL_COLUMNS).select(F.lit(i).alias("member"), "*") for i, m in enumerate(self.classifiers)
        ]
        # The scaler is read off what its stage makes of a 0 and a 1 in every column.
        probe = spark.range(2).select(*[F.col("id").cast("double").alias(c) for c in MODEL_COLUMNS])
        ends = self.preprocessing.stages[-2].transform(probe).select([F.col(quoted(scaled_name(c))) for c in MODEL_COLUMNS]).collect()
        zero, one = sorted(map(tuple, ends), key=sum)
        units = spark.createDataFrame([(c, a, b - a) for c, a, b in zip(MODEL_COLUMNS, zero, one)], "feature string, zero double, unit double")
        raw = {end: (F.col(end) - F.col("zero")) / F.col("unit") for end in ("low", "high")}
        return reduce(DataFrame.unionByName, steps).join(F.broadcast(units), "feature").withColumns(raw).select("member", "feature", "low", "high", "dependence")


_MANIFEST = "version string, classifiers array<string>, thresholds map<string, double>"


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> str:
    """Write a new version below ``path`` and commit it; returns its name.

    Stages, tree tables and thresholds go into a folder of their own, and one line of
    ``manifest`` that names it is written last. Until then readers see the version before.
    """
    version = uuid.uuid4().hex
    place = f"{path}/versions/{version}"
    stages = [c for c in bundle.classifiers if not isinstance(c, BoostedTrees)]
    PipelineModel([bundle.preprocessing, *stages]).write().save(f"{place}/model")
    kinds = []
    for i, c in enumerate(bundle.classifiers):
        kinds.append("trees" if isinstance(c, BoostedTrees) else "stage")
        if isinstance(c, BoostedTrees):
            c.nodes(spark).write.parquet(f"{place}/trees/{i}/nodes")
            c.state(spark).write.parquet(f"{place}/trees/{i}/state")
    thresholds = {k: float(v) for k, v in bundle.thresholds.items()}
    line = spark.createDataFrame([(version, kinds, thresholds)], _MANIFEST)
    line.withColumn("committed", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _committed(spark: SparkSession, path: str) -> Row | None:
    """The last committed version; None where nothing was ever saved."""
    try:
        manifest = spark.read.parquet(f"{path}/manifest")
    except AnalysisException:
        return None
    return manifest.orderBy(F.desc("committed"), "version").first()


def load_thresholds(spark: SparkSession, path: str) -> dict[str, float]:
    """Thresholds of the committed version over the defaults; a bundle without any uses 0.5 throughout."""
    last = _committed(spark, path)
    return {**DEFAULT_THRESHOLDS, **(last["thresholds"] if last else {})}


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The last committed version: its model always comes with its own thresholds."""
    last = _committed(spark, path)
    if last is None:
        raise FileNotFoundError(f"no committed bundle below {path}")
    place = f"{path}/versions/{last['version']}"
    preprocessing, *stages = PipelineModel.load(f"{place}/model").stages
    left, classifiers = iter(stages), []
    for i, kind in enumerate(last["classifiers"]):
        parts = [spark.read.parquet(f"{place}/trees/{i}/{name}") for name in ("nodes", "state")] if kind == "trees" else []
        classifiers.append(BoostedTrees.restore(*parts) if parts else next(left))
    return Bundle(preprocessing, tuple(classifiers), {**DEFAULT_THRESHOLDS, **last["thresholds"]})
