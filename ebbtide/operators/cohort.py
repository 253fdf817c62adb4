"""Comparison of customers with the history of similar ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.schema import TARGET
from ebbtide.session import materialise

TENURE_SPAN = 12  # fixed value: months on either side that count as similar
_CELL = ("Contract", "InternetService", "tenure")


def cohort_table(history: DataFrame) -> DataFrame:
    """Size and churn rate of the cohort around every (contract, internet, tenure) cell.

    History is first counted per cell. Each cell then adds its counts to the cells whose
    cohort it belongs to: 25 integer keys per cell, then one more partial aggregate. The
    work after the first count depends on the number of cells only, and no range join is
    needed.
    """
    cells = (
        history.where(F.col("Contract").isNotNull() & F.col("InternetService").isNotNull() & F.col("tenure").isNotNull())
        .groupBy(*_CELL)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(TARGET).isNotNull()).alias("known"),
            F.count_if(F.col(TARGET) == "Yes").alias("churned"),
        )
    )
    # A cohort never reaches below tenure 0.
    reach = F.sequence(F.col("tenure") - TENURE_SPAN, F.col("tenure") + TENURE_SPAN)
    spread = cells.where(F.col("tenure") >= 0).select(
        "Contract", "InternetService", F.explode(reach).alias("tenure"), "n", "known", "churned"
    )
    return spread.groupBy(*_CELL).agg(
        F.sum("n").alias("similar_customers"),
        F.coalesce(F.try_divide(F.sum("churned"), F.sum("known")), F.lit(0.0)).alias("cohort_churn_rate"),
    )


def similar_customers(probes: DataFrame, history: DataFrame) -> DataFrame:
    """Add the cohort size and its churn rate to every probe.

    The cohort table is written first, so the planner sees its size: it is broadcast while
    it is small, and otherwise joined by key with skewed keys split at run time.
    """
    joined = probes.join(materialise(cohort_table(history)), list(_CELL), "left")
    return joined.withColumns(
        {
            "similar_customers": F.coalesce("similar_customers", F.lit(0)),
            "cohort_churn_rate": F.coalesce("cohort_churn_rate", F.lit(0.0)),
        }
    )


def cohort_risk_compare(compared: DataFrame, probability: str = "p") -> DataFrame:
    higher = F.col(probability) > F.col("cohort_churn_rate")
    return compared.withColumn(
        "risk_vs_cohort", F.when(higher, "higher than average").otherwise("lower than average")
    )
