"""Curves and sweeps against brute force, ties and degenerate labels included."""

import random

import pytest

from ebbtide.operators import evaluation as ev
from ebbtide.operators import impact, scoring


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "p double, y int")


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(3)
    return [(round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 2), y) for y in (rng.randrange(2) for _ in range(400))]


def brute_auc(pairs):
    pos, neg = [p for p, y in pairs if y], [p for p, y in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, last, area = sum(y for _, y in pairs), 0.0, 0.0
    for t in sorted({p for p, _ in pairs}, reverse=True):
        taken = [y for p, y in pairs if p >= t]
        recall = sum(taken) / total
        area += (recall - last) * sum(taken) / len(taken)
        last = recall
    return area


@pytest.mark.parametrize("per_bucket", [4, 1_000_000])
def test_areas(spark, pairs, per_bucket):
    row = ev.area_metrics(frame(spark, pairs), rows_per_bucket=per_bucket).first()
    assert row["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)
    assert row["avg_precision"] == pytest.approx(brute_ap(pairs), abs=1e-12)


def test_many_bucket_curves_equal_the_plain_ones(spark, pairs):
    df = frame(spark, pairs)
    for make in (ev.roc_curve, ev.pr_curve):
        few, many = (sorted(map(str, make(df, rows_per_bucket=n).collect())) for n in (1_000_000, 5))
        assert few == many


def test_dropped_points_leave_the_area(spark, pairs):
    def area(rows):
        points = sorted((r["fpr"], r["tpr"]) for r in rows)
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))

    df = frame(spark, pairs + [(0.001 * i, 1) for i in range(5)])
    short, full = ev.roc_curve(df).collect(), ev.roc_curve(df, drop_intermediate=False).collect()
    assert len(short) < len(full) and area(short) == pytest.approx(area(full))


def test_sweep_counts_at_exact_thresholds(spark):
    grid = [0.1 + i * 0.008 for i in range(101)]
    pairs = [(t, i % 2) for i, t in enumerate(grid)] + [(0.0, 1), (0.0999, 0), (1.0, 1)]
    rows = {r["position"]: r for r in ev.threshold_counts(frame(spark, pairs)).collect()}
    assert len(rows) == 101
    for i, t in enumerate(grid):
        assert rows[i]["threshold"] == t
        assert rows[i]["tp"] == sum(y == 1 and p >= t for p, y in pairs)
        assert rows[i]["fp"] == sum(y == 0 and p >= t for p, y in pairs)
        assert rows[i]["fn"] == sum(y == 1 and p < t for p, y in pairs)


def test_first_best_threshold_wins(spark):
    best = ev.best_f1_threshold(frame(spark, [(0.95, 1), (0.05, 0)])).first()
    assert (best["threshold"], best["f1_score"]) == (0.1, 1.0)
    money = ev.best_business_threshold(frame(spark, [(0.95, 1), (0.05, 0)])).first()
    assert (money["threshold"], money["net_benefit"]) == (0.1, 900.0)


def test_both_thresholds_from_one_sweep(spark, pairs):
    df = frame(spark, pairs)
    found = ev.best_thresholds(df)
    assert found == {
        "default": 0.5,
        "f1_threshold": ev.best_f1_threshold(df).first()["threshold"],
        "business_threshold": ev.best_business_threshold(df).first()["threshold"],
    }


def test_labels_of_one_class(spark):
    row = ev.evaluate_model(frame(spark, [(0.2, 0), (0.8, 0)])).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["roc_auc"], row["avg_precision"]) == (0, 0, 0, None, None)
    assert ev.threshold_sweep(frame(spark, [(0.2, 0)])).where("f1_score <> 0").count() == 0
    assert {r["recall"] for r in ev.pr_curve(frame(spark, [(0.2, 0)])).collect()} == {1.0, 0.0}


def test_all_scores_equal(spark):
    assert ev.roc_auc(frame(spark, [(0.5, 1), (0.5, 0), (0.5, 0)])).first()["roc_auc"] == 0.5


def test_confusion_keeps_empty_cells(spark):
    rows = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(frame(spark, [(0.9, 1)])).collect()}
    assert rows == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_first_model_wins_a_tie(spark):
    df = spark.createDataFrame([(1, "b", 0.5), (0, "a", 0.5), (2, "c", 0.4)], "position int, model string, f1_score double")
    assert ev.select_best_model(df).first()["model"] == "a"


def test_grouped_evaluation_equals_single(spark, pairs):
    long = [("m", p, y) for p, y in pairs] + [("n", 1 - p, y) for p, y in pairs]
    rows = {r["model"]: r for r in ev.evaluate_model(spark.createDataFrame(long, "model string, p double, y int"), by=("model",)).collect()}
    alone = ev.evaluate_model(frame(spark, pairs)).first()
    for c in ev.METRICS:
        assert rows["m"][c] == pytest.approx(alone[c])
    assert rows["n"]["roc_auc"] == pytest.approx(1 - alone["roc_auc"])


@pytest.mark.parametrize("size", [2, 1_000_000])
def test_rows_without_score_or_label_change_nothing(spark, size):
    good = [(0.1, 0), (0.3, 1), (0.5, 0), (0.7, 1), (0.9, 1)]
    clean = frame(spark, good)
    gaps = frame(spark, [*good, (None, 1), (None, 0), (float("nan"), 1), (float("nan"), 0), (0.6, None)])
    for f in (ev.confusion_counts, ev.threshold_sweep, ev.business_sweep, ev.evaluate_model, ev.best_f1_threshold):
        assert sorted(f(gaps).collect()) == sorted(f(clean).collect())
    for f in (ev.roc_curve, ev.pr_curve, ev.area_metrics):
        assert set(f(gaps, rows_per_bucket=size).collect()) == set(f(clean, rows_per_bucket=size).collect())
    assert 0 <= ev.evaluate_model(gaps).first()["roc_auc"] <= 1
    assert tuple(ev.unscored_counts(gaps).first()) == (10, 4, 1)


def test_no_prediction_without_a_probability(spark):
    rows = spark.createDataFrame([(0.8,), (None,), (float("nan"),)], "p double")
    got = [tuple(r) for r in scoring.prediction_table(rows, "p", 0.5).collect()]
    assert got == [(0.8, 1, "High"), (None, None, None), (None, None, None)]


def test_campaign_targets_no_row_without_a_score(spark):
    rows = [(0.9, 1), (0.1, 0), (float("nan"), 1), (None, 0), (0.85, None)]
    out = impact.campaign_roi(spark.createDataFrame(rows, "p double, y int"), (0.05, 0.8)).collect()
    assert {r["threshold"]: r["targeted"] for r in out} == {0.05: 3, 0.8: 2}
