"""The registered queries: one per operator, each over the whole subscriber table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import bands, features
from ebbtide.operators import (
    attribution,
    cleaning,
    cohort,
    evaluation,
    explain,
    impact,
    linear,
    models,
    payloads,
    ranking,
    reports,
    sampling,
    scoring,
    segments,
    tree_explain,
    validation,
)
from ebbtide.operators.models import FITTERS
from ebbtide.operators.smote import balance, synthetic_rows
from ebbtide.plans.training import TrainingRun, candidate_metrics, out_of_fold_scores, prepare, prepare_folds, train_and_select
from ebbtide.schema import ID, NUMERIC, TARGET, quoted
from ebbtide.session import materialise, shared_folder
from ebbtide.sources import files
from ebbtide.sources.bundle import Bundle, load_bundle, save_bundle
from ebbtide.sources.tables import requests, subscribers
from ebbtide.streaming.score import score_stream

#: Rounds of the boosters whose properties are counted.
PROPERTY_ROUNDS = 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Centroids in raw units for the checked segment queries.
CENTROIDS = {0: (12.0, 60.0, 700.0), 1: (36.0, 65.0, 2400.0), 2: (58.0, 95.0, 5500.0)}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def simple(name: str, build: Callable[[DataFrame], DataFrame], digits: int = 6) -> None:
    """A query that needs nothing but the subscriber table."""
    QUERIES[name] = lambda spark, folder: rounded(build(subscribers(spark, folder)), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits: sums may be added up in any order."""
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.selectExpr(*[f"round({quoted(c)}, {digits}) AS {quoted(c)}" if c in real else quoted(c) for c in df.columns])


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own for every call: an earlier result stays readable."""
    return f"{shared_folder(spark)}/roundtrip/{name}-{uuid.uuid4().hex}"


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_customers(subscribers(spark, folder))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.create_features(clean(spark, folder))


# --- sources and sinks ------------------------------------------------------------------


@query("scan_customers")
def scan_customers(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "customers_csv")
    files.write_csv(subscribers(spark, folder), path)
    return files.read_customers(spark, path)


@query("scan_requests_json")
def scan_requests_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "requests_json")
    files.write_requests(requests(spark, folder), path)
    return files.read_requests(spark, path)


@query("write_predictions")
def write_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "predictions")
    files.write_predictions(scoring.score_batch(subscribers(spark, folder)), path)
    return files.read_predictions(spark, path)


@query("write_segments")
def write_segments(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "segments")
    files.write_segments(segments.segment_profile(_segmented(spark, folder)), path)
    return files.read_segments(spark, path)


@query("write_importance")
def write_importance(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "importance")
    files.write_importance(explain.shap_linear(subscribers(spark, folder)), path)
    return rounded(files.read_importance(spark, path), 9)


@query("write_metrics")
def write_metrics(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "metrics")
    files.write_metrics(evaluation.evaluate_model(_scored(spark, folder)), path)
    return rounded(files.read_metrics(spark, path))


@query("read_artifacts")
def read_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """A metrics file that lacks two numbers: the reader fills in the defaults."""
    path = scratch(spark, "metrics_partial")
    measured = evaluation.evaluate_model(_scored(spark, folder))
    files.write_metrics(measured.drop("precision", "recall"), path)
    return rounded(files.read_metrics(spark, path))


@query("write_curves")
def write_curves(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "curves")
    frame = _scored(spark, folder)
    files.write_curve(evaluation.roc_curve(frame), f"{path}/roc")
    files.write_curve(evaluation.pr_curve(frame), f"{path}/pr")
    roc = files.read_curve(spark, f"{path}/roc").select(F.lit("roc").alias("curve"), F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    pr = files.read_curve(spark, f"{path}/pr").select(F.lit("pr").alias("curve"), F.col("recall").alias("x"), F.col("precision").alias("y"))
    return rounded(roc.unionByName(pr))


# --- projections and cleaning -----------------------------------------------------------

simple("coerce_numeric", lambda d: cleaning.coerce_numeric(d).select(ID, "TotalCharges"))
simple("drop_incomplete", lambda d: cleaning.drop_incomplete(cleaning.coerce_numeric(d)).select(ID, "tenure", "TotalCharges"))
simple("recode_senior", lambda d: cleaning.recode_senior(d).select(ID, "SeniorCitizen"))
simple("recode_target", lambda d: cleaning.recode_target(d).select(ID, TARGET))
simple("target_to_label", lambda d: cleaning.target_to_label(cleaning.recode_target(d)).select(ID, TARGET))
simple("clean_customers", cleaning.clean_customers)
simple("drop_columns", lambda d: cleaning.drop_columns(cleaning.clean_customers(d)))
simple("spend_ratios", lambda d: cleaning.with_expressions(cleaning.clean_customers(d), features.SPEND_RATIOS).select(ID, *features.SPEND_RATIOS))


def feature_query(name: str, columns: dict[str, str]) -> None:
    simple(name, lambda d: d.selectExpr(ID, *[f"{sql} AS {quoted(c)}" for c, sql in columns.items()]))


feature_query(
    "tenure_bucket",
    {"Tenure_Bucket": features.TENURE_BUCKET, "position": features.interval_rank(f"({features.TENURE_BUCKET})", features.TENURE_BUCKETS)},
)
feature_query(
    "tenure_group",
    {"tenure_group": features.TENURE_GROUP, "position": features.interval_rank(f"({features.TENURE_GROUP})", features.TENURE_GROUPS)},
)
feature_query("service_count", {"ServiceCount": features.SERVICE_COUNT})
feature_query("cost_per_service", {"Cost_per_Service": features.COST_PER_SERVICE})
feature_query("service_flags", features.SERVICE_FLAGS)
feature_query("contract_tenure", {"Contract_Tenure": features.CONTRACT_TENURE})
feature_query("no_security", {"NoSecurity": features.NO_SECURITY})
feature_query("high_risk_payment", {"HighRiskPayment": features.HIGH_RISK_PAYMENT})


@query("senior_high_charge")
def senior_high_charge(spark: SparkSession, folder: str) -> DataFrame:
    rows = subscribers(spark, folder)
    median = ranking.exact_median(rows, "MonthlyCharges")
    return rows.select(ID, F.expr(features.senior_high_charge(median, False)).alias("Senior_HighCharge"))


@query("create_features")
def create_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(featured(spark, folder))


@query("select_important")
def select_important(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.select_important(featured(spark, folder)))


@query("one_hot_drop_first")
def one_hot_drop_first(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.one_hot_drop_first(featured(spark, folder)))


@query("one_hot_align")
def one_hot_align(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.one_hot_align(cleaning.coerce_numeric(subscribers(spark, folder)))


@query("standard_scale")
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Scaler fitted on the training part, applied to both parts."""
    coded = cleaning.one_hot_drop_first(featured(spark, folder))
    train, _ = sampling.stratified_split(coded)
    return rounded(cleaning.standard_scale(coded, cleaning.fit_scaler(train)))


simple("default_total_charges", lambda d: cleaning.default_total_charges(d).select(ID, "TotalCharges"))


def _with_score(d: DataFrame) -> DataFrame:
    return linear.score_linear(d)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return linear.scored(subscribers(spark, folder))


simple("score_linear", lambda d: _with_score(d).select(ID, "p"))
simple("risk_level", lambda d: _with_score(d).select(ID, "p", bands.risk_level("p").alias("risk_level")))


@query("apply_threshold")
def apply_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions under the three threshold modes, the two fitted ones found by one sweep."""
    frame = _scored(spark, folder)
    thresholds = evaluation.best_thresholds(frame)
    modes = ("default", "f1", "business")
    return frame.select(
        ID,
        "p",
        *[
            scoring.apply_threshold("p", scoring.choose_threshold(thresholds, m)).alias(f"predicted_{m}")
            for m in modes
        ],
    )


simple("risk_factors", lambda d: d.select(ID, F.explode_outer(bands.risk_factors()).alias("risk_factor")))
simple(
    "recommendations",
    lambda d: scoring.score_batch(d).select(
        ID, "predicted_churn", F.posexplode(bands.actions("predicted_churn")).alias("position", "action")
    ),
)
simple("charge_scatter", cleaning.charge_scatter)
simple("charge_scatter_binned", cleaning.binned_scatter)


# --- filters and validators --------------------------------------------------------------

_CONTRACTS, _SERVICES = ("Month-to-month", "Two year"), ("DSL", "Fiber optic")
simple("filter_customers", lambda d: validation.filter_customers(d, _CONTRACTS, _SERVICES))
simple("filter_counts", lambda d: validation.filter_counts(d, _CONTRACTS, _SERVICES))
simple("filter_options", validation.filter_options)
simple("first_year_monthly", lambda d: validation.first_year_monthly(d).select(ID, "Contract", "tenure", "MonthlyCharges"))


@query("validate_strict")
def validate_strict(spark: SparkSession, folder: str) -> DataFrame:
    checked = validation.validate_strict(requests(spark, folder))
    return checked.select(ID, "tenure", "MonthlyCharges", "InternetService", "Contract", "PaymentMethod", "error")


@query("validate_lenient")
def validate_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return validation.validate_lenient(requests(spark, folder)).select(ID, "tenure", "MonthlyCharges", "Contract", "error")


@query("validate_frame")
def validate_frame(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the sound table and on the damaged requests, strict and lenient."""
    sound, damaged = subscribers(spark, folder), requests(spark, folder)
    cases = (("sound", sound, True), ("sound", sound, False), ("requests", damaged, True), ("requests", damaged, False))
    out = None
    for name, frame, strict in cases:
        line = validation.validate_frame(frame, strict).select(
            F.lit(name).alias("input"), F.lit(strict).alias("strict"), "is_valid", "message"
        )
        out = line if out is None else out.unionByName(line)
    return out


@query("split_valid")
def split_valid(spark: SparkSession, folder: str) -> DataFrame:
    return validation.split_valid(requests(spark, folder)).select("customer_id", "tenure", "MonthlyCharges", "Contract", "error")


simple("complete_numeric", lambda d: cleaning.complete_numeric(d))


# --- joins --------------------------------------------------------------------------------


def _similar(spark: SparkSession, folder: str) -> DataFrame:
    rows = subscribers(spark, folder)
    return cohort.similar_customers(_with_score(rows), rows)


@query("similar_customers")
def similar_customers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        _similar(spark, folder).select(ID, "Contract", "InternetService", "tenure", "similar_customers", "cohort_churn_rate")
    )


@query("cohort_risk_compare")
def cohort_risk_compare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cohort.cohort_risk_compare(_similar(spark, folder)).select(ID, "p", "cohort_churn_rate", "risk_vs_cohort"))


@query("baseline_compare")
def baseline_compare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluation.baseline_compare(evaluation.evaluate_model(_scored(spark, folder))))


# --- aggregates ----------------------------------------------------------------------------

simple("churn_kpis", reports.churn_kpis)
simple("churn_distribution", reports.churn_distribution)
simple("churn_by_contract", lambda d: reports.churn_rate_by(d, "Contract"))
simple("churn_by_internet", lambda d: reports.churn_rate_by(d, "InternetService"))
simple("churn_by_payment", lambda d: reports.churn_rate_by(d, "PaymentMethod"))
simple("churn_by_tenure_group", reports.churn_by_tenure_group)
simple("crosstab_rate", lambda d: reports.crosstab_rate(d, "MultipleLines"))
simple("lifetime_value", reports.lifetime_value)
simple("correlation_matrix", reports.correlation_matrix)
simple("class_counts", lambda d: sampling.class_counts(cleaning.clean_customers(d)))
simple("class_weights", lambda d: sampling.class_weights(cleaning.clean_customers(d)))
simple("observed_dependence", reports.observed_dependence)


@query("median_charge")
def median_charge(spark: SparkSession, folder: str) -> DataFrame:
    median = ranking.exact_median(subscribers(spark, folder), "MonthlyCharges")
    return rounded(spark.range(1).select(F.lit(median).alias("median_charge")))


@query("median_sketch")
def median_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """The median charge from sketches stored per contract, and whether its rank is within 0.5 %."""
    rows, path = subscribers(spark, folder), scratch(spark, "sketches")
    ranking.median_sketches(rows, "MonthlyCharges", ("Contract",)).write.parquet(path)
    stored = spark.read.parquet(path)
    middle = ranking.merged_median(stored)
    charge = F.col("MonthlyCharges")
    counted = rows.agg(
        F.count("MonthlyCharges").alias("n"),
        ((F.count_if(charge < middle) <= 0.505 * F.count(charge)) & (F.count_if(charge <= middle) >= 0.495 * F.count(charge))).alias("within"),
    )
    both = counted.unionByName(stored.agg(F.sum("n").alias("sketched")), allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("n", "within", "sketched")])


def scored_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """A query over the evaluation frame (key, score, label)."""
    QUERIES[name] = lambda spark, folder: rounded(build(_scored(spark, folder)))


scored_query("confusion_matrix", evaluation.confusion_matrix)
scored_query("classification_report", evaluation.classification_report)
scored_query("evaluate_model", evaluation.evaluate_model)
scored_query("threshold_sweep", evaluation.threshold_sweep)
scored_query("best_f1_threshold", evaluation.best_f1_threshold)
scored_query("business_sweep", evaluation.business_sweep)
scored_query("best_business_threshold", evaluation.best_business_threshold)
scored_query("argmax_threshold", lambda d: evaluation.argmax_threshold(evaluation.threshold_sweep(d), "precision"))
scored_query("roc_curve", evaluation.roc_curve)
scored_query("roc_curve_full", lambda d: evaluation.roc_curve(d, drop_intermediate=False))
scored_query("roc_auc", evaluation.roc_auc)
scored_query("pr_curve", evaluation.pr_curve)
scored_query("average_precision", evaluation.average_precision)
scored_query("campaign_roi", impact.campaign_roi)
scored_query("threshold_impact", impact.threshold_impact)
scored_query("annual_value", impact.annual_value)


@query("at_risk_total")
def at_risk_total(spark: SparkSession, folder: str) -> DataFrame:
    return impact.at_risk_total(scoring.score_batch(subscribers(spark, folder)))


@query("predicted_vs_actual")
def predicted_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    """Period: year and month of the customer's latest order."""
    rows = subscribers(spark, folder, extra=("last_order",))
    period = (F.year("last_order") * 100 + F.month("last_order")).alias("period")
    return impact.predicted_vs_actual(linear.scored(rows.select("*", period), keep=("period",)))


# --- sorts, samples, balancing ---------------------------------------------------------------

# Shares of a round number of rows end in a 5 at the seventh digit now and then; at the
# ninth digit there is nothing left to round either way.
simple("importance_table", lambda d: explain.importance_table(explain.shap_linear(d)), 9)
simple("top_features", lambda d: explain.top_features(explain.shap_linear(d)), 9)
simple("preview", lambda d: sampling.preview(scoring.score_batch(d)))
simple("explain_sample", lambda d: sampling.explain_sample(d).select(ID, "tenure", "MonthlyCharges", "Contract"))


@query("select_best_model")
def select_best_model(spark: SparkSession, folder: str) -> DataFrame:
    """Four scorers evaluated in one job, the best by F1 kept."""
    long = linear.scored_by_all(subscribers(spark, folder))
    metrics = evaluation.evaluate_model(long, by=("position", "model"))
    return rounded(evaluation.select_best_model(metrics))


simple("stratified_split", lambda d: d.select(ID, TARGET, sampling.is_test().alias("is_test")))
simple("stratified_split_exact", lambda d: sampling.stratified_test_exact(d).select(ID, TARGET))
simple("undersample", lambda d: sampling.undersample(cleaning.clean_customers(d)).select(ID, TARGET))
simple("class_weighting", lambda d: sampling.with_weights(cleaning.clean_customers(d), "balanced").select(ID, TARGET, "weight"))


# --- scoring -------------------------------------------------------------------------------

simple("score_batch", scoring.score_batch)


@query("score_records")
def score_records(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_records(requests(spark, folder))


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as written bodies: an even tenure is sent as a number in a list, any other as
    text in an object, and a tenure of 7 as a body that is no JSON."""
    rows, path = requests(spark, folder), scratch(spark, "bodies")
    sent = {"tenure": F.col("tenure").try_cast("int"), "MonthlyCharges": F.col("MonthlyCharges").try_cast("double")}
    typed = F.struct(*[sent.get(c, F.col(c)).alias(c) for c in rows.columns])
    text = F.struct(*[F.col(c) if c == "tenure" else sent.get(c, F.col(c)).alias(c) for c in rows.columns])
    body = F.when(sent["tenure"] == 7, "tenure=7").when(sent["tenure"] % 2 == 0, F.to_json(F.array(typed))).otherwise(F.to_json(text))
    files.write_payloads(rows.select(body.alias("payload")), path)
    return files.read_payloads(spark, path)


@query("validate_payloads")
def validate_payloads(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.checked_payloads(_payloads(spark, folder)).select("customer_id", "error", "Contract")


@query("score_payloads")
def score_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies read by the lenient rules score as the requests in them."""
    return payloads.score_payloads(_payloads(spark, folder))


@query("soft_vote")
def soft_vote(spark: SparkSession, folder: str) -> DataFrame:
    rows = subscribers(spark, folder)
    names = [f"p_{s.name}" for s in linear.SCORERS]
    scores = rows.select(ID, *[s.probability().alias(n) for s, n in zip(linear.SCORERS, names)])
    return rounded(linear.soft_vote(scores, tuple(names)), 8)  # a fourth of six digits has eight


# --- segments --------------------------------------------------------------------------------


def _segmented(spark: SparkSession, folder: str) -> DataFrame:
    return segments.assign_segments(clean(spark, folder), CENTROIDS)


@query("assign_segments")
def assign_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segmented(spark, folder).select(ID, *NUMERIC, "Cluster")


@query("segment_profile")
def segment_profile(spark: SparkSession, folder: str) -> DataFrame:
    return segments.segment_profile(_segmented(spark, folder))


@query("segment_risk")
def segment_risk(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(segments.segment_risk(segments.segment_profile(_segmented(spark, folder))))


# --- explanation -------------------------------------------------------------------------------

simple("shap_linear", explain.shap_linear, 9)
simple("shap_linear_rows", explain.shap_linear_rows)
simple("partial_dependence", explain.partial_dependence)


# --- streaming -----------------------------------------------------------------------------------


@query("score_stream")
def stream_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests land as JSON files, a stream scores them, the output table is read back."""
    place = scratch(spark, f"stream_{uuid.uuid4().hex}")
    files.write_requests(requests(spark, folder), f"{place}/in")
    score_stream(spark, f"{place}/in", f"{place}/out", f"{place}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{place}/out")


# --- fitted models -----------------------------------------------------------------------------------

_RUNS: dict[tuple[str, str, str], TrainingRun] = {}


def training_run(spark: SparkSession, folder: str, method: str = "smote") -> TrainingRun:
    """One training run per session and folder: its models are fitted once and shared by
    the queries below."""
    key = (spark.sparkContext.applicationId, folder, method)
    if key not in _RUNS:
        _RUNS[key] = prepare(clean(spark, folder), method)
    return _RUNS[key]


def _fit_query(name: str, model: str) -> None:
    QUERIES[name] = lambda spark, folder: rounded(training_run(spark, folder).metrics((model,)).drop("position"))


for _model in FITTERS:
    _fit_query(f"fit_{_model}", _model)


@query("booster_properties")
def booster_properties(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for the trees of each own booster, counted over its node table: trees, trees
    beyond the limits of leaves and depth, leaves whose value is not -G / (H + penalty) times
    the rate, levels with more than one condition (symmetric trees) and rounds without a lower
    training loss."""
    balanced = training_run(spark, folder).balanced
    fitters = {"gbt_weighted": (models.fit_gbt_weighted, models.WEIGHTED), "gbt_leafwise": (models.fit_gbt_leafwise, models.LEAFWISE)}
    fitters["gbt_symmetric"] = (models.fit_gbt_symmetric, models.SYMMETRIC)
    out = None
    for name, (fit, how) in fitters.items():
        model = fit(balanced, rounds=PROPERTY_ROUNDS)
        nodes = materialise(model.nodes(spark))
        value = -F.lit(how.rate) * F.col("gradient") / (F.col("hessian") + F.lit(how.penalty))
        wrong = F.count_if((F.col("feature") < 0) & (F.col("rows") > 0) & (F.abs(F.col("value") - value) > 1e-12))
        shape = nodes.groupBy("tree").agg(F.count_if(F.col("feature") < 0).alias("leaves"), F.max("depth").alias("depth"), wrong.alias("wrong"))
        levels = nodes.where("feature >= 0").groupBy("tree", "depth").agg(F.countDistinct("feature", "cut").alias("conditions"))
        mixed = levels.where("conditions > 1").count() if how.policy == "symmetric" else 0
        rises = sum(b >= a for a, b in zip(model.losses, model.losses[1:]))
        line = shape.agg(
            F.count(F.lit(1)).alias("trees"),
            F.count_if((F.col("leaves") > min(how.leaves, 1 << how.depth)) | (F.col("depth") > how.depth)).alias("too_large"),
            F.sum("wrong").alias("wrong_leaves"),
        ).select(
            F.lit(name).alias("model"),
            "*",
            F.lit(rises).cast("long").alias("rounds_without_gain"),
            F.lit(mixed).cast("long").alias("mixed_levels"),
        )
        out = line if out is None else out.unionByName(line)
    return out


@query("train_and_select")
def select_trained(spark: SparkSession, folder: str) -> DataFrame:
    """All seven candidates with their quality, the chosen one and its thresholds."""
    chosen = train_and_select(training_run(spark, folder))
    return rounded(
        chosen.metrics.withColumns(
            {
                "selected": F.col("model") == chosen.name,
                **{n: F.when(F.col("model") == chosen.name, F.lit(v)) for n, v in chosen.thresholds.items()},
            }
        )
    )


@query("out_of_fold_selection")
def out_of_fold_selection(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for a choice on three folds: rows scored per candidate, test rows among them,
    and whether the one chosen is the first with the best F1."""
    names = ("logistic", "random_forest")
    scores = out_of_fold_scores(prepare_folds(clean(spark, folder), 3), names)
    metrics = materialise(candidate_metrics(scores, names))
    best = evaluation.select_best_model(metrics).first()["model"]
    top = max(metrics.collect(), key=lambda r: (r["f1_score"], -r["position"]))["model"]
    known = [F.count(F.nanvl(f"p_{n}", F.lit(None).cast("double"))).alias(n) for n in names]
    counts = scores.agg(*known, F.countDistinct("row_key").alias("customers"), F.count_if(sampling.is_test("row_key")).alias("test_rows"))
    lines = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("n_rows")) for n in names]))
    return counts.select(lines.alias("l"), "customers", "test_rows").select("l.*", "customers", "test_rows", F.lit(best == top).alias("first_best"))


def _short_trees(run: TrainingRun) -> dict[str, models.Classifier]:
    """Tree models of few rounds, fitted once per run."""
    fitters = {"gbt_leafwise": models.fit_gbt_leafwise, "random_forest": models.fit_random_forest}
    for name, fit in fitters.items():
        if f"short_{name}" not in run.fitted:
            run.fitted[f"short_{name}"] = fit(run.balanced, PROPERTY_ROUNDS)
    return {name: run.fitted[f"short_{name}"] for name in fitters}


@query("tree_contributions")
def tree_contributions(spark: SparkSession, folder: str) -> DataFrame:
    """Exact Shapley values of every test row: rows, features, and rows whose values add up to
    the model's output minus its expected output."""
    run, out = training_run(spark, folder), None
    for name, model in _short_trees(run).items():
        boxes = materialise(tree_explain.leaf_boxes(tree_explain.node_table(spark, model)))
        phi = tree_explain.shap_trees(model, run.test, features.MODEL_COLUMNS, boxes=boxes)
        total = phi.groupBy(F.col("row").alias("row_key")).agg(F.sum("phi").alias("phi"), F.countDistinct("feature").alias("n_seen"))
        p = F.col("p")
        output = (p if name == "random_forest" else F.log(p / (1 - p))) - tree_explain.expected_output(model, boxes)
        met = models.churn_probability(run.test, model).join(total, "row_key")
        line = met.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.max("n_seen").alias("n_features"),
            F.count_if(F.abs(output - F.col("phi")) < 1e-8).alias("adding_up"),
        ).select(F.lit(name).alias("model"), "*")
        out = line if out is None else out.unionByName(line)
    return out


@query("tree_dependence")
def tree_dependence(spark: SparkSession, folder: str) -> DataFrame:
    """Partial dependence of a bundle's tree models over their whole range: features, and steps
    that do not begin where the one before ends."""
    run = training_run(spark, folder)
    made = Bundle(run.preprocessing, tuple(_short_trees(run).values()), {})
    order = Window.partitionBy("member", "feature").orderBy("low")
    steps = made.dependence(spark).withColumn("_end", F.lag("high").over(order))
    return steps.groupBy("member").agg(
        F.countDistinct("feature").alias("n_features"),
        F.count_if(F.col("low") != F.coalesce("_end", F.lit(float("-inf")))).alias("broken"),
        F.count_if(F.col("high") == float("inf")).alias("last_steps"),
    )


@query("feature_importance")
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(models.feature_importance(spark, training_run(spark, folder).model("random_forest")))


@query("save_load_bundle")
def save_load_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """A saved and reloaded bundle scores the whole raw table."""
    run, path = training_run(spark, folder), scratch(spark, "bundle")
    save_bundle(spark, Bundle(run.preprocessing, (run.model("logistic"),), {"f1_threshold": 0.52}), path)
    return rounded(load_bundle(spark, path).score(subscribers(spark, folder), mode="f1"))


@query("score_records_bundle")
def score_records_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """Request records validated and scored by a fitted model."""
    run = training_run(spark, folder)
    made = Bundle(run.preprocessing, (run.model("logistic"),), {})
    return rounded(made.score_records(requests(spark, folder)))


@query("score_records_gaps")
def score_records_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Total charges that are no number score as missing ones do: records, valid ones, those
    with a score, and those with the score of a record without total charges. A tenure of -1
    has no charge per month, so such a record has no score."""
    run = training_run(spark, folder)
    made = Bundle(run.preprocessing, (run.model("logistic"),), {})
    rows = materialise(requests(spark, folder).where("customerID IS NOT NULL"))
    absent = made.score_records(rows.withColumn("TotalCharges", F.lit(None).cast("string"))).select("customer_id", F.col("churn_probability").alias("_absent"))
    out = None
    for gap in ("NaN", "1.0d", "abc"):
        scored = made.score_records(rows.withColumn("TotalCharges", F.lit(gap))).join(absent, "customer_id")
        line = scored.agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("error").isNull()).alias("valid"),
            F.count("churn_probability").alias("scored"),
            F.count_if(F.abs(F.col("churn_probability") - F.col("_absent")) < 1e-12).alias("as_missing"),
        ).select(F.lit(gap).alias("gap"), "*")
        out = line if out is None else out.unionByName(line)
    return out


@query("oversample_smote")
def oversample_smote(spark: SparkSession, folder: str) -> DataFrame:
    """Class sizes of the training part before and after."""
    run = training_run(spark, folder)
    before = sampling.class_counts(run.train, "label").withColumnRenamed("n", "before")
    after = sampling.class_counts(run.balanced, "label").withColumnRenamed("n", "after")
    return before.join(after, "label")


@query("smote_segments")
def smote_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Synthetic rows of the training part, those on the segment between their two rows, and
    those both of whose rows are rows of the minority class."""
    train = training_run(spark, folder).train.withColumn("features", vector_to_array("features"))
    made = materialise(synthetic_rows(train).withColumn("number", F.monotonically_increasing_id()))
    apart = F.aggregate(
        F.zip_with("features", F.zip_with("x", "y", lambda a, b: a + F.col("gap") * (b - a)), lambda f, g: F.abs(f - g)),
        F.lit(0.0), lambda a, b: F.greatest(a, b),
    )
    known = train.select("label", F.col("features").alias("row")).distinct()
    ends = made.select("number", "label", F.explode(F.array("x", "y")).alias("row")).join(known, ["label", "row"])
    both = ends.groupBy("number").agg(F.count(F.lit(1)).alias("ends")).where("ends = 2")
    return made.join(both, "number", "left").groupBy("label").agg(
        F.count(F.lit(1)).alias("synthetic"),
        F.count_if((apart < 1e-9) & F.col("gap").between(0, 1)).alias("on_segment"),
        F.count("ends").alias("between_minority_rows"),
    )


@query("balance")
def balance_methods(spark: SparkSession, folder: str) -> DataFrame:
    """Class sizes under each balancing method."""
    train = training_run(spark, folder).train.withColumn("features", vector_to_array("features"))
    out = None
    for method in ("smote", "undersampling", "class_weight", "other"):
        balanced = training_run(spark, folder).balanced if method == "smote" else balance(train, method)
        line = sampling.class_counts(balanced, "label").select(F.lit(method).alias("method"), "label", "n")
        out = line if out is None else out.unionByName(line)
    return out


@query("fit_segments")
def fit_segments(spark: SparkSession, folder: str) -> DataFrame:
    """k-means on the training part, then the profile of its segments."""
    train, _ = sampling.stratified_split(clean(spark, folder))
    found = models.fit_segments(train)
    return segments.segment_profile(segments.assign_segments(train, found.centroids, scaler=found.scaler))


@query("segment_centers")
def segment_centers(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = sampling.stratified_split(clean(spark, folder))
    rows = [(c, *centre) for c, centre in models.fit_segments(train).centers().items()]
    return rounded(spark.createDataFrame(rows, "Cluster int, tenure double, MonthlyCharges double, TotalCharges double"))


@query("shap_sampled")
def shap_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """100 test rows explained against 50 training rows."""
    run = training_run(spark, folder)
    sample = sampling.preview(run.test, "row_key", 100)
    background = sampling.explain_sample(run.train, "row_key", 50)
    return rounded(attribution.shap_sampled(run.model("random_forest"), sample, background, features.MODEL_COLUMNS))


@query("permutation_importance")
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    run = training_run(spark, folder)
    found = attribution.permutation_importance(run.model("logistic"), run.test, features.MODEL_COLUMNS)
    return rounded(explain.importance_table(found))
