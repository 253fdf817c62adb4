"""Whole jobs over files: train on a customer CSV, score a customer CSV with what was saved."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.features import MODEL_COLUMNS
from ebbtide.operators import attribution, cleaning, evaluation, models, sampling, segments
from ebbtide.operators.tree_explain import is_tree_model, shap_trees
from ebbtide.plans.training import MODELS, Selection, TrainingRun, prepare, prepare_folds, select_out_of_fold, train_and_select
from ebbtide.session import materialise
from ebbtide.sources import files
from ebbtide.sources.bundle import Bundle, load_bundle, save_bundle


def _members(run: TrainingRun, name: str) -> tuple[models.Classifier, ...]:
    """The classifiers behind a candidate: four if the vote won."""
    return tuple(run.model(m) for m in (models.VOTERS if name == "vote" else (name,)))


def _mean(parts: Sequence[DataFrame], value: str) -> DataFrame:
    """Mean of ``value`` over tables with the same keys."""
    whole = reduce(DataFrame.unionByName, parts)
    return whole.groupBy(*[c for c in whole.columns if c != value]).agg(F.avg(value).alias(value))


def importance(run: TrainingRun, name: str) -> DataFrame:
    """(Feature, Importance) of a candidate: that of its trees, or by permutation where it has none."""
    spark, found = run.test.sparkSession, []
    for model in _members(run, name):
        table = models.feature_importance(spark, model)
        found.append(attribution.permutation_importance(model, run.test, MODEL_COLUMNS) if table is None else table)
    return _mean([t.select("Feature", "Importance") for t in found], "Importance")


def contributions(run: TrainingRun, name: str, rows: int = 100, background: int = 50) -> DataFrame:
    """Shapley values (row, feature, phi) of a candidate, for ``rows`` test rows.

    Exact for a single tree model, sampled against ``background`` rows otherwise. The sampled
    values of a mean of models are the mean of their values.
    """
    if name != "vote" and is_tree_model(run.model(name)):
        return shap_trees(run.model(name), sampling.preview(run.test, "row_key", rows), MODEL_COLUMNS)
    sample = sampling.preview(run.test, "row_key", rows)
    base = sampling.explain_sample(run.train, "row_key", background)
    return _mean([attribution.shap_sampled(m, sample, base, MODEL_COLUMNS) for m in _members(run, name)], "phi")


def save_run(run: TrainingRun, chosen: Selection, customers: DataFrame, folder: str, explained: int = 100, background: int = 50) -> None:
    """Write the chosen candidate and everything measured on it below ``folder``.

    ``bundle`` (with the swept thresholds), ``metrics``, ``roc``, ``pr``, ``importance``,
    ``segments`` of the training part of the cleaned ``customers``, and ``contributions``.
    """
    spark, name = run.test.sparkSession, chosen.name
    save_bundle(spark, Bundle(run.preprocessing, _members(run, name), chosen.thresholds), f"{folder}/bundle")
    files.write_metrics(chosen.test_metrics, f"{folder}/metrics")
    frame = materialise(run.scores((name,)).select(F.col(f"p_{name}").alias("p"), "y"))
    files.write_curve(evaluation.roc_curve(frame), f"{folder}/roc")
    files.write_curve(evaluation.pr_curve(frame), f"{folder}/pr")
    files.write_importance(importance(run, name), f"{folder}/importance")
    train, _ = sampling.stratified_split(customers)
    found = models.fit_segments(train)
    profile = segments.segment_profile(segments.assign_segments(train, found.centroids, scaler=found.scaler))
    files.write_segments(profile, f"{folder}/segments")
    contributions(run, name, explained, background).write.mode("overwrite").parquet(f"{folder}/contributions")


def train(
    spark: SparkSession, csv: str, folder: str, method: str = "smote", names: tuple[str, ...] = MODELS, folds: int = 0
) -> Selection:
    """Read, clean, split, balance, fit the candidates ``names``, keep the best by F1, save it.

    With ``folds`` the choice and the thresholds come from out-of-fold scores of the training
    part, else from the test part.
    """
    customers = materialise(cleaning.clean_customers(files.read_customers(spark, csv)))
    run = prepare(customers, method)
    chosen = select_out_of_fold(run, prepare_folds(customers, folds, method), names) if folds else train_and_select(run, names)
    save_run(run, chosen, customers, folder)
    return chosen


def score(spark: SparkSession, csv: str, folder: str, out: str, mode: str = "default") -> DataFrame:
    """Score a customer CSV with the bundle that ``train`` saved; the predictions are written as CSV."""
    bundle = load_bundle(spark, f"{folder}/bundle")
    files.write_predictions(bundle.score(files.read_customers(spark, csv), mode), out)
    return files.read_predictions(spark, out)
