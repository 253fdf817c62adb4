"""Fitted models: preprocessing, probabilities, selection, explanation invariants."""

import threading
import uuid

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbtide.functions.features import MODEL_COLUMNS
from ebbtide.operators import attribution, models, sampling, scoring
from ebbtide.plans import jobs, training
from ebbtide.plans.queries import clean, scratch
from ebbtide.session import materialise
from ebbtide.sources import files
from ebbtide.sources import bundle as bundles
from ebbtide.sources.bundle import Bundle, load_bundle, load_thresholds, save_bundle
from ebbtide.sources.tables import requests, subscribers
from ebbtide.streaming.score import score_stream


@pytest.fixture(scope="module")
def run(spark, folder):
    made = training.prepare(clean(spark, folder))
    made.fitted.update(
        {
            "random_forest": models.fit_random_forest(made.balanced, trees=5),
            "gbt_weighted": models.fit_gbt_weighted(made.balanced, rounds=2),
            "gbt_leafwise": models.fit_gbt_leafwise(made.balanced, rounds=2),
            "gbt_symmetric": models.fit_gbt_symmetric(made.balanced, rounds=2),
            "gbt": models.fit_gbt(made.balanced, rounds=2),
        }
    )
    return made


def test_training_features_are_scaled(run):
    row = run.train.select(F.posexplode(vector_to_array("features")).alias("j", "v")).groupBy("j").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")
    )
    for r in row.collect():
        assert r["m"] == pytest.approx(0, abs=1e-9)
        assert r["s"] == pytest.approx(1, abs=1e-9) or r["s"] == 0
    assert row.count() == len(MODEL_COLUMNS) == 46


def test_classes_are_balanced(run):
    counts = [r["count"] for r in run.balanced.groupBy("label").count().collect()]
    assert len(counts) == 2 and counts[0] == counts[1]


def test_selection(run):
    chosen = training.train_and_select(run)
    rows = chosen.metrics.orderBy("position").collect()
    assert [r["model"] for r in rows] == list(training.MODELS)
    assert chosen.name == max(rows, key=lambda r: (r["f1_score"], -r["position"]))["model"]
    assert 0.1 <= chosen.thresholds["f1_threshold"] <= 0.9
    assert all(0 <= r["roc_auc"] <= 1 for r in rows)


def test_vote_is_the_mean(run):
    row = run.scores(("gbt_weighted", "gbt_leafwise", "gbt_symmetric", "gbt", "vote")).first()
    members = [row[f"p_{m}"] for m in models.VOTERS]
    assert row["p_vote"] == pytest.approx(sum(members) / 4)


def test_bundle_scores_raw_rows_like_the_run(spark, folder, run):
    path = scratch(spark, "bundle_test")
    save_bundle(spark, Bundle(run.preprocessing, (run.model("gbt"), run.model("logistic")), {"business_threshold": 0.2}), path)
    loaded = load_bundle(spark, path)
    assert loaded.thresholds == {"default": 0.5, "f1_threshold": 0.5, "business_threshold": 0.2}
    out = loaded.score(subscribers(spark, folder), mode="business")
    assert out.count() == 150
    both = run.scores(("gbt", "logistic")).join(out, F.col("row_key") == F.col("customerID"))
    gap = both.select(F.max(F.abs((F.col("p_gbt") + F.col("p_logistic")) / 2 - F.col("churn_probability")))).first()[0]
    assert gap < 1e-12
    assert out.where((F.col("churn_probability") >= 0.2) != (F.col("predicted_churn") == 1)).count() == 0
    assert "customerID" not in loaded.score(subscribers(spark, folder).drop("customerID")).columns


def test_saved_run_scores_a_file(spark, folder, run):
    chosen, place = training.train_and_select(run), scratch(spark, "job_test")
    jobs.save_run(run, chosen, clean(spark, folder), place, explained=3, background=4)
    files.write_csv(subscribers(spark, folder), f"{place}/csv")
    for mode in ("f1", "business"):
        out = jobs.score(spark, f"{place}/csv", place, f"{place}/out_{mode}", mode=mode)
        assert out.count() == 150
        limit = chosen.thresholds[f"{mode}_threshold"]
        assert out.where((F.col("churn_probability") >= limit) != (F.col("predicted_churn") == 1)).count() == 0
    assert files.read_metrics(spark, f"{place}/metrics").first()["f1_score"] == pytest.approx(
        chosen.metrics.where(F.col("model") == chosen.name).first()["f1_score"]
    )
    assert files.read_importance(spark, f"{place}/importance").count() == 46
    assert files.read_segments(spark, f"{place}/segments").agg(F.sum("Count")).first()[0] == run.train.count()
    assert spark.read.parquet(f"{place}/contributions").select("row").distinct().count() == 3


def test_vote_is_explained_by_its_members(run):
    table = {r["Feature"]: r["Importance"] for r in jobs.importance(run, "vote").collect()}
    assert set(table) == set(MODEL_COLUMNS) and sum(table.values()) == pytest.approx(1)


def test_bundle_scores_records_in_batch_and_stream(spark, folder, run):
    made = Bundle(run.preprocessing, (run.model("logistic"),), {})
    place, sent = scratch(spark, f"records_{uuid.uuid4().hex}"), requests(spark, folder)
    sent.write.json(f"{place}/in")
    score_stream(spark, f"{place}/in", f"{place}/out", f"{place}/checkpoint", made.score_records).awaitTermination()
    batch = made.score_records(sent)
    assert sorted(map(str, spark.read.parquet(f"{place}/out").collect())) == sorted(map(str, batch.collect()))
    assert batch.where(F.col("error").isNull() == F.col("churn_probability").isNull()).count() == 0
    whole = {r["customerID"]: r["churn_probability"] for r in made.score(subscribers(spark, folder)).collect()}
    same = batch.where("error IS NULL AND customer_id <> 'Unknown'").collect()
    assert sum(abs(r["churn_probability"] - whole[r["customer_id"]]) < 1e-12 for r in same) > 100


def test_bundle_accepts_missing_columns(spark, folder, run):
    made = Bundle(run.preprocessing, (run.model("logistic"),), {})
    few = subscribers(spark, folder).select("customerID", "tenure", "MonthlyCharges", "Contract")
    assert made.score(few).where("churn_probability BETWEEN 0 AND 1").count() == 150


def test_importance_needs_trees(spark, run):
    assert models.feature_importance(spark, run.model("logistic")) is None
    table = models.feature_importance(spark, run.model("random_forest"))
    assert table.count() == 46 and table.agg(F.sum("Importance")).first()[0] == pytest.approx(1)


def test_shapley_values_add_up(run):
    model = run.model("random_forest")
    sample, background = sampling.preview(run.test, "row_key", 4), sampling.explain_sample(run.train, "row_key", 6)
    phi = attribution.shap_sampled(model, sample, background, MODEL_COLUMNS)
    total = {r["row"]: r["s"] for r in phi.groupBy("row").agg(F.sum("phi").alias("s")).collect()}
    base = models.churn_probability(background, model).agg(F.avg("p")).first()[0]
    for r in models.churn_probability(sample, model).collect():
        assert total[r["row_key"]] == pytest.approx(r["p"] - base)


def test_permuting_an_unused_feature_costs_nothing(run):
    model = run.model("logistic")
    found = {r["Feature"]: r["Importance"] for r in attribution.permutation_importance(model, run.test, MODEL_COLUMNS, ring=10).collect()}
    assert set(found) == set(MODEL_COLUMNS)
    silent = [n for n, c in zip(MODEL_COLUMNS, model.coefficients) if abs(c) < 1e-12]
    assert all(found[n] == 0 for n in silent)


def test_segments_are_numbered_by_tenure(spark, folder):
    found = models.fit_segments(clean(spark, folder))
    tenures = [c[0] for _, c in sorted(found.centers().items())]
    assert tenures == sorted(tenures) and len(tenures) == 3
    assert 0 <= tenures[0] and tenures[-1] <= 72


def test_bundle_of_own_boosters(spark, folder, run):
    """Tree tables are saved beside the stages, in the order of the classifiers."""
    path = scratch(spark, "trees_test")
    kinds = ("gbt_leafwise", "logistic", "gbt_symmetric")
    save_bundle(spark, Bundle(run.preprocessing, tuple(run.model(m) for m in kinds), {}), path)
    loaded = load_bundle(spark, path)
    out = loaded.score(subscribers(spark, folder))
    both = run.scores(kinds).join(out, F.col("row_key") == F.col("customerID"))
    mean = sum(F.col(f"p_{m}") for m in kinds) / 3
    assert both.select(F.max(F.abs(mean - F.col("churn_probability")))).first()[0] < 1e-12


def test_bundle_is_committed_as_a_whole(spark, run, monkeypatch):
    """A crash between the writes leaves the old model with the old thresholds."""
    path = scratch(spark, "commit_test")
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, path)
    assert load_thresholds(spark, path) == {"default": 0.5, "f1_threshold": 0.5, "business_threshold": 0.5}
    old = Bundle(run.preprocessing, (run.model("logistic"),), {"f1_threshold": 0.3})
    save_bundle(spark, old, path)
    new = Bundle(run.preprocessing, (run.model("gbt_leafwise"),), {"f1_threshold": 0.9})
    with monkeypatch.context() as m:
        m.setattr(bundles.F, "current_timestamp", lambda: 1 / 0)  # model and trees are written, the manifest is not
        with pytest.raises(ZeroDivisionError):
            save_bundle(spark, new, path)
    now = load_bundle(spark, path)
    assert now.thresholds["f1_threshold"] == 0.3 and isinstance(now.classifiers[0], type(run.model("logistic")))
    save_bundle(spark, new, path)
    now = load_bundle(spark, path)
    assert now.thresholds["f1_threshold"] == 0.9 and type(now.classifiers[0]).__name__ == "BoostedTrees"


def test_test_rows_influence_neither_choice_nor_thresholds(spark, folder):
    table = materialise(clean(spark, folder))
    flipped = table.withColumn("Churn", F.when(sampling.is_test(), 1 - F.col("Churn")).otherwise(F.col("Churn")))
    names = ("logistic", "random_forest")
    found = [training.select_out_of_fold(training.prepare(t), training.prepare_folds(t, 2), names) for t in (table, flipped)]
    assert found[0].name == found[1].name and found[0].thresholds == found[1].thresholds
    tables = [[tuple(r) for r in c.metrics.orderBy("position").collect()] for c in found]
    assert tables[0] == tables[1] and [r[1] for r in tables[0]] == list(names)
    held = [c.test_metrics.collect() for c in found]
    assert [[r["model"] for r in h] for h in held] == 2 * [[found[0].name]] and held[0][0]["roc_auc"] != held[1][0]["roc_auc"]


def test_folds_share_no_customer_and_cover_the_training_part(spark, folder):
    table = clean(spark, folder)
    folds = [f.test.select("row_key").toPandas()["row_key"].tolist() for f in training.prepare_folds(table, 3)]
    train, _ = sampling.stratified_split(table)
    assert sorted(sum(folds, [])) == sorted(r[0] for r in train.select("customerID").collect())
    with pytest.raises(ValueError, match="two folds"):
        training.prepare_folds(table, 1)


def test_bundle_explains_raw_rows_in_raw_units(spark, folder, run):
    made = Bundle(run.preprocessing, (run.model("gbt_leafwise"), run.model("random_forest")), {})
    rows = subscribers(spark, folder)
    phi = made.contributions(rows).groupBy("member", "row").agg(F.count("phi").alias("n"))
    assert {(r["member"], r["n"]) for r in phi.collect()} == {(0, 46), (1, 46)} and phi.count() == 2 * rows.count()
    steps = made.dependence(spark)
    cuts = steps.where("feature = 'tenure' and low > double('-inf')").select("low").distinct().collect()
    # Cuts lie between months of the rows, synthetic ones included.
    assert cuts and all(0 < r["low"] < 72 for r in cuts)
    ends = steps.where("feature = 'Contract_Two year'").agg(F.min("high"), F.max("low")).first()
    assert all(v in (float("inf"), float("-inf")) or 0 <= round(v, 9) <= 1 for v in ends)


def test_records_without_a_probability_say_so(spark, folder, run):
    made = Bundle(run.preprocessing, (run.model("random_forest"),), {})
    rows = requests(spark, folder).where("customerID is not null").limit(20)
    good = made.score_records(rows.withColumn("TotalCharges", F.lit(None).cast("string"))).orderBy("customer_id").collect()
    for gap in ("NaN", "1.0d", "abc"):
        assert made.score_records(rows.withColumn("TotalCharges", F.lit(gap))).orderBy("customer_id").collect() == good
    frame = spark.createDataFrame([("a", None, float("nan")), ("b", None, None), ("c", "bad", 0.9), ("d", None, 0.9)], "customer_id string, error string, p double")
    got = {r["customer_id"]: tuple(r)[1:] for r in scoring.record_table(frame, F.col("p")).collect()}
    none = (scoring.NO_SCORE, None, None, None)
    assert got == {"a": none, "b": none, "c": ("bad", None, None, None), "d": (None, 0.9, True, "High")}


def test_folds_overlap(spark, folder, monkeypatch):
    prepared, fitted = threading.Barrier(2, timeout=20), threading.Barrier(2, timeout=20)

    class Fold:
        def fit_all(self, names):
            fitted.wait()

        def scores(self, names):
            return spark.range(1).select(F.col("id").alias("row_key"))

    monkeypatch.setattr(training, "_prepared", lambda *_: prepared.wait() * 0 or Fold())
    folds = training.prepare_folds(clean(spark, folder), 2)
    assert training.out_of_fold_scores(folds, ("logistic",)).count() == 2
