"""From probabilities to decisions: thresholds, risk levels, result tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.bands import number, risk_level
from ebbtide.operators.linear import MAIN, LinearScorer
from ebbtide.operators.validation import split_valid
from ebbtide.schema import ID

# The threshold used when none is stored.
DEFAULT_THRESHOLDS = {"default": 0.5, "f1_threshold": 0.5, "business_threshold": 0.5}
NO_SCORE = "No score for these values"
_MODE_KEY = {"f1": "f1_threshold", "business": "business_threshold"}


def choose_threshold(thresholds: Mapping[str, float], mode: str = "default") -> float:
    """Threshold for a mode (default, f1, business); 0.5 for anything else."""
    return thresholds.get(_MODE_KEY[mode], 0.5) if mode in _MODE_KEY else 0.5


def apply_threshold(probability: str | Column, threshold: float) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return (F.nanvl(p, F.lit(None).cast("double")) >= threshold).cast("int")


def prediction_table(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    """customerID (when present), churn_probability, predicted_churn, risk_level."""
    return df.select(
        *[c for c in (ID,) if c in df.columns],
        F.nanvl(F.col(probability), F.lit(None).cast("double")).alias("churn_probability"),
        apply_threshold(probability, threshold).alias("predicted_churn"),
        risk_level(probability).alias("risk_level"),
    )


def score_batch(df: DataFrame, threshold: float = 0.5, scorer: LinearScorer = MAIN) -> DataFrame:
    """Batch scoring with the linear scorer, one narrow pass over the file."""
    return prediction_table(df.withColumn("_p", scorer.probability()), "_p", threshold)


def record_table(checked: DataFrame, probability: Column, threshold: float = 0.5) -> DataFrame:
    """customer_id, error, churn_probability, will_churn, risk_level of validated records.

    A record that failed validation keeps its message in ``error`` and has no score. One whose
    probability is null or NaN has none either, and ``error`` says so.
    """
    known = F.nanvl(probability, F.lit(None).cast("double"))
    scored = checked.withColumn("churn_probability", F.when(F.col("error").isNull(), known))
    return scored.select(
        "customer_id",
        F.coalesce("error", F.when(F.col("churn_probability").isNull(), F.lit(NO_SCORE))).alias("error"),
        "churn_probability",
        (F.col("churn_probability") >= threshold).alias("will_churn"),
        risk_level("churn_probability").alias("risk_level"),
    )


def score_records(requests: DataFrame, threshold: float = 0.5, scorer: LinearScorer = MAIN) -> DataFrame:
    """Validate and score request records with the linear scorer, in one pass."""
    typed = split_valid(requests, strict=False).withColumns(
        {
            "tenure": number("tenure"),
            "MonthlyCharges": number("MonthlyCharges"),
            "SeniorCitizen": F.coalesce(F.col("SeniorCitizen").try_cast("int"), F.lit(0)),
        }
    )
    return record_table(typed, scorer.probability(), threshold)
