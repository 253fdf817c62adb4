"""Money: campaign returns, threshold impact, yearly value, drift of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.evaluation import (
    RETENTION_COST,
    VALUE_SAVED,
    confusion_counts,
    evaluation_frame,
    ratio,
    simple_metrics,
)

# Share of approached customers that stay, and the campaign thresholds.
RETENTION_RATE = 0.3
CAMPAIGN_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def campaign_roi(df: DataFrame, thresholds: Sequence[float] = CAMPAIGN_THRESHOLDS) -> DataFrame:
    """Cost and return of a campaign at each threshold; all thresholds in one pass.

    A null or NaN score targets nobody. Labels are not needed.
    """
    score = F.nanvl(F.col("p").cast("double"), F.lit(None).cast("double"))
    counts = df.agg(*[F.count_if(score >= t).alias(f"n{i}") for i, t in enumerate(thresholds)])
    lines = [F.struct(F.lit(t).alias("threshold"), F.col(f"n{i}").alias("targeted")) for i, t in enumerate(thresholds)]
    table = counts.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
    return (
        table.withColumn("cost", F.col("targeted") * RETENTION_COST)
        .withColumn("saved", F.col("targeted") * RETENTION_RATE)
        .withColumn("revenue", F.col("saved") * VALUE_SAVED)
        .withColumn("net_benefit", F.col("revenue") - F.col("cost"))
        .withColumn("roi", ratio(F.col("net_benefit"), F.col("cost")))
    )


def threshold_impact(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Measured quality and money at one threshold."""
    measured = simple_metrics(confusion_counts(df, threshold))
    flagged = F.col("tp") + F.col("fp")
    return (
        measured.select(
            F.lit(threshold).alias("threshold"),
            "precision",
            "recall",
            "f1_score",
            "accuracy",
            flagged.alias("flagged"),
            F.col("tp").alias("saved"),
            (flagged * RETENTION_COST).alias("cost"),
            (F.col("tp") * VALUE_SAVED).alias("benefit"),
        )
        .withColumn("net_benefit", F.col("benefit") - F.col("cost"))
        .withColumn("roi", ratio(F.col("net_benefit"), F.col("cost")))
    )


def annual_value(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Yearly worth: churners, the share the model finds, the share that can be kept."""
    measured = simple_metrics(confusion_counts(df, threshold))
    saved = F.col("churners") * F.col("identified_share") * RETENTION_RATE
    return measured.select(
        (F.col("tp") + F.col("fn")).alias("churners"), F.col("recall").alias("identified_share")
    ).withColumns({"customers_saved": saved, "annual_value": saved * VALUE_SAVED})


def predicted_vs_actual(df: DataFrame, period: str = "period", threshold: float = 0.5) -> DataFrame:
    """Predicted and actual churners per period, with the error."""
    counts = (
        evaluation_frame(df)
        .where(F.col(period).isNotNull())
        .groupBy(period)
        .agg(F.count_if(F.col("p") >= threshold).alias("predicted"), F.sum("y").alias("actual"))
    )
    diff = F.col("predicted") - F.col("actual")
    return counts.withColumns({"difference": diff, "absolute_error": F.abs(diff)})


def at_risk_total(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.sum("predicted_churn").alias("at_risk"), F.count(F.lit(1)).alias("customers"))
