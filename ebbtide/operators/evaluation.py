"""Confusion counts, classification reports, threshold sweeps and curves.

The input is an evaluation frame with a score ``p`` and a label ``y`` (1/0). Every
function takes ``by``, the grouping columns, so many models are evaluated in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ranking import ROWS_PER_BUCKET, running_totals
from ebbtide.session import materialise

# The threshold grid (101 points from 0.1 to 0.9), the worth of a kept
# customer and the cost of one retention offer.
GRID_START, GRID_STEP, GRID_POINTS = 0.1, 0.008, 101
VALUE_SAVED, RETENTION_COST = 1000.0, 100.0

METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "avg_precision")


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where it is undefined."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def _known(column: str) -> Column:
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double")).isNotNull()


def evaluation_frame(df: DataFrame) -> DataFrame:
    """Rows that have a score and a label. A null or NaN in either leaves a row out of every
    figure of this module; ``unscored_counts`` says how many those are."""
    return df.where(_known("p") & _known("y"))


def unscored_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per group, and those without a score or without a label."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~_known("p")).alias("without_score"),
        F.count_if(~_known("y")).alias("without_label"),
    )


def confusion_counts(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn in one row per group."""
    flag, real = F.col("p") >= threshold, F.col("y") == 1
    return evaluation_frame(df).groupBy(*by).agg(
        F.count_if(flag & real).alias("tp"),
        F.count_if(flag & ~real).alias("fp"),
        F.count_if(~flag & real).alias("fn"),
        F.count_if(~flag & ~real).alias("tn"),
    )


def confusion_matrix(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """Four lines (actual, predicted, n); a cell without rows shows 0."""
    cells = F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)")
    return confusion_counts(df, threshold, by).select(*by, cells)


def simple_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 added to confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + fp + fn + tn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": f1(tp, fp, fn),
        }
    )


def classification_report(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per-class lines, accuracy, and the plain and weighted means over the classes."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n, n1, n0 = tp + fp + fn + tn, tp + fn, tn + fp
    one = (ratio(tp, tp + fp), ratio(tp, tp + fn), f1(tp, fp, fn))
    zero = (ratio(tn, tn + fn), ratio(tn, tn + fp), f1(tn, fn, fp))
    names = ("precision", "recall", "f1_score")
    empty = F.lit(None).cast("double")

    def line(label: str, values: Sequence[Column], support: Column) -> Column:
        return F.struct(
            F.lit(label).alias("label"), *[v.alias(c) for v, c in zip(values, names)], support.alias("support")
        )

    lines = [
        line("0", zero, n0),
        line("1", one, n1),
        line("accuracy", (empty, empty, ratio(tp + tn, n)), n),
        line("macro avg", [(a + b) / 2 for a, b in zip(zero, one)], n),
        line("weighted avg", [ratio(a * n0 + b * n1, n) for a, b in zip(zero, one)], n),
    ]
    return confusion_counts(df, threshold).select(F.explode(F.array(*lines)).alias("l")).select("l.*")


# --- threshold sweeps ---------------------------------------------------------------


def grid_value(index: Column) -> Column:
    return F.lit(GRID_START) + index * F.lit(GRID_STEP)


def thresholds_reached(p: Column) -> Column:
    """How many grid thresholds are at or below ``p``: an arithmetic guess, put right by
    comparing with the two exact neighbours."""
    guess = F.floor((p - GRID_START) / GRID_STEP)
    reached = (
        F.when(grid_value(guess + 1) <= p, guess + 2)
        .when(grid_value(guess) <= p, guess + 1)
        .otherwise(guess)
    )
    return F.greatest(F.lit(0), F.least(F.lit(GRID_POINTS), reached))


def threshold_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn at all 101 thresholds.

    Scores are first counted into 102 cells, which is the only pass over the rows; the
    running sums then cover at most 102 lines per group.
    """
    by = list(by)
    cells = evaluation_frame(df).groupBy(*by, thresholds_reached(F.col("p")).cast("int").alias("cell")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    # One array per group holds the 102 cells, so thresholds without rows appear too.
    packed = cells.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("pos", "neg")))).alias("cells"),
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
    )
    lines = packed.select(
        *by,
        "cells",
        "all_pos",
        "all_neg",
        F.explode(F.sequence(F.lit(1), F.lit(GRID_POINTS))).alias("cell"),
    ).select(
        *by,
        "all_pos",
        "all_neg",
        "cell",
        F.coalesce(F.try_element_at("cells", "cell")["pos"], F.lit(0)).alias("pos"),
        F.coalesce(F.try_element_at("cells", "cell")["neg"], F.lit(0)).alias("neg"),
    )
    above = Window.partitionBy(*by).orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return lines.select(
        *by,
        (F.col("cell") - 1).alias("position"),
        grid_value(F.col("cell") - 1).alias("threshold"),
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        "all_pos",
        "all_neg",
    ).select(
        *by,
        "position",
        "threshold",
        "tp",
        "fp",
        (F.col("all_pos") - F.col("tp")).alias("fn"),
        (F.col("all_neg") - F.col("fp")).alias("tn"),
    )


def threshold_sweep(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1, precision and recall at every grid threshold."""
    return simple_metrics(threshold_counts(df, by)).select(
        *by, "position", "threshold", "f1_score", "precision", "recall"
    )


def business_sweep(
    df: DataFrame, value_saved: float = VALUE_SAVED, cost: float = RETENTION_COST, by: Sequence[str] = ()
) -> DataFrame:
    """Net benefit of approaching everyone above each grid threshold."""
    net = F.col("tp") * value_saved - (F.col("tp") + F.col("fp")) * cost
    return threshold_counts(df, by).select(*by, "position", "threshold", "tp", "fp", net.alias("net_benefit"))


def argmax_threshold(sweep: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """First threshold with the highest value of ``metric``."""
    best = F.max_by(F.struct("threshold", metric), F.struct(F.col(metric), -F.col("position")))
    return sweep.groupBy(*by).agg(best.alias("b")).select(*by, "b.threshold", f"b.{metric}")


def best_f1_threshold(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return argmax_threshold(threshold_sweep(df, by), "f1_score", by)


def best_business_threshold(
    df: DataFrame, value_saved: float = VALUE_SAVED, cost: float = RETENTION_COST, by: Sequence[str] = ()
) -> DataFrame:
    return argmax_threshold(business_sweep(df, value_saved, cost, by), "net_benefit", by)


def best_thresholds(
    df: DataFrame, value_saved: float = VALUE_SAVED, cost: float = RETENTION_COST
) -> dict[str, float]:
    """The stored thresholds of a model, both fitted ones from one sweep of the scores."""
    net = F.col("tp") * value_saved - (F.col("tp") + F.col("fp")) * cost
    swept = simple_metrics(threshold_counts(df)).withColumn("net_benefit", net)
    first = -F.col("position")
    row = swept.agg(
        F.max_by("threshold", F.struct("f1_score", first)).alias("f1_threshold"),
        F.max_by("threshold", F.struct("net_benefit", first)).alias("business_threshold"),
    ).first()
    return {"default": 0.5, **row.asDict()}


# --- curves ---------------------------------------------------------------------------


def score_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, written once. All curve work starts
    here; the evaluation frame itself is read a single time."""
    return materialise(
        evaluation_frame(df).groupBy(*by, "p").agg(
            F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
        )
    )


def curve_points(counts: DataFrame, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Score counts with tp and fp, counted from the highest score down."""
    points = running_totals(counts, "p", ["pos", "neg"], by, rows_per_bucket=rows_per_bucket)
    return points.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def _class_totals(counts: DataFrame) -> tuple[int, int]:
    row = counts.agg(F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))).first()
    return row[0], row[1]


def roc_curve(df: DataFrame, drop_intermediate: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, fpr, tpr) from the strictest threshold down, starting at (inf, 0, 0).

    With ``drop_intermediate`` a point is left out when the step before it equals the step
    after it, since the line through it stays straight.
    """
    counts = score_counts(df)
    positives, negatives = _class_totals(counts)
    points = curve_points(counts, rows_per_bucket=rows_per_bucket)
    if drop_intermediate:
        first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
        turns = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        points = points.where(first | F.col("next_pos").isNull() | turns)
    curve = points.select(
        F.col("p").alias("threshold"),
        F.try_divide("fp", F.lit(negatives)).alias("fpr"),
        F.try_divide("tp", F.lit(positives)).alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(curve)


def pr_curve(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (null, 1, 0)."""
    counts = score_counts(df)
    positives, _ = _class_totals(counts)
    curve = curve_points(counts, rows_per_bucket=rows_per_bucket).select(
        F.col("p").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(F.try_divide("tp", F.lit(positives)), F.lit(1.0)).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return curve.unionByName(end)


def area_metrics(df: DataFrame, by: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """roc_auc (ties count one half) and avg_precision (step-wise) per group.

    Both are sums over the curve points, so no order is needed once the running totals
    are known. Both are null when a class is missing.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    sums = curve_points(score_counts(df, by), by, rows_per_bucket).groupBy(*by).agg(
        F.sum(neg * (tp - pos / 2)).alias("pairs"),
        F.sum(pos * tp / (tp + fp)).alias("steps"),
        F.sum("pos").cast("double").alias("all_pos"),
        F.sum("neg").cast("double").alias("all_neg"),
    )
    return sums.select(
        *by,
        F.try_divide("pairs", F.col("all_pos") * F.col("all_neg")).alias("roc_auc"),
        F.try_divide("steps", "all_pos").alias("avg_precision"),
    )


def roc_auc(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return area_metrics(df, rows_per_bucket=rows_per_bucket).select("roc_auc")


def average_precision(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    return area_metrics(df, rows_per_bucket=rows_per_bucket).select("avg_precision")


def evaluate_model(df: DataFrame, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """The six quality numbers, one row per group.

    The distinct scores with their class counts carry everything: the table is read once
    and both the confusion counts and the areas come from that summary.
    """
    by = list(by)
    points = curve_points(score_counts(df, by), by)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    flag = F.col("p") >= threshold
    sums = points.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(flag, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(flag, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~flag, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~flag, F.col("neg"))), F.lit(0)).alias("tn"),
        F.sum(neg * (tp - pos / 2)).alias("pairs"),
        F.sum(pos * tp / (tp + fp)).alias("steps"),
    )
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    return simple_metrics(sums).select(
        *by,
        "accuracy",
        "precision",
        "recall",
        "f1_score",
        F.try_divide("pairs", (positives * negatives.cast("double"))).alias("roc_auc"),
        F.try_divide("steps", positives).alias("avg_precision"),
    )


def select_best_model(metrics: DataFrame) -> DataFrame:
    """Highest F1; the earlier ``position`` wins a tie."""
    return metrics.orderBy(F.col("f1_score").desc(), F.col("position")).limit(1)


# The comparison baseline.
BASELINE = {"accuracy": 0.735, "roc_auc": 0.65, "f1_score": 0.41}


def baseline_compare(metrics: DataFrame) -> DataFrame:
    """Current against baseline value per metric, the difference in points."""
    lines = F.array(
        *[
            F.struct(F.lit(m).alias("metric"), F.lit(b).alias("baseline"), F.col(m).alias("current"))
            for m, b in BASELINE.items()
        ]
    )
    compared = metrics.select(F.explode(lines).alias("l")).select("l.*")
    return compared.withColumn("improvement", (F.col("current") - F.col("baseline")) * 100)
