"""Scoring with fixed linear coefficients, as plain column expressions.

This is the serving form of a logistic model: no Python and no model object in the scan,
and every score can be recomputed in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.bands import one_zero
from ebbtide.schema import ID, TARGET, literal, quoted


@dataclass(frozen=True)
class Term:
    """A weighted number, or a weighted indicator of one level of a text column."""

    column: str
    weight: float
    level: str | None = None

    @property
    def name(self) -> str:
        return self.column if self.level is None else f"{self.column}_{self.level}"

    @property
    def sql(self) -> str:
        """The unweighted value as a double."""
        column = quoted(self.column)
        return f"CAST({column if self.level is None else f'({column} <=> {literal(self.level)})'} AS DOUBLE)"

    def contribution(self, value: float | str) -> float:
        """What the term adds when its column has ``value``."""
        return self.weight * (value if self.level is None else float(value == self.level))


@dataclass(frozen=True)
class LinearScorer:
    """``p = 1 / (1 + exp(-z))`` with ``z`` the intercept plus the terms."""

    name: str
    intercept: float
    terms: tuple[Term, ...]

    def logit_sql(self, without: str | None = None) -> str:
        """``z`` as SQL text, on request without the terms of one column."""
        z = f"{self.intercept!r}D"
        for term in self.terms:
            if term.column != without:
                z = f"({z} + {term.sql} * {term.weight!r}D)"
        return z

    def probability_sql(self, logit: str | None = None) -> str:
        return f"round(1 / (1 + exp(-({logit or self.logit_sql()}))), 6)"

    def probability(self) -> Column:
        return F.expr(self.probability_sql())


# The coefficients of the checked scorers.
MAIN = LinearScorer(
    "main",
    -1.5,
    (
        Term("tenure", -0.03),
        Term("MonthlyCharges", 0.01),
        Term("Contract", 1.25, "Month-to-month"),
        Term("Contract", -0.75, "Two year"),
        Term("InternetService", 0.5, "Fiber optic"),
        Term("OnlineSecurity", 0.25, "No"),
        Term("TechSupport", 0.2, "No"),
        Term("PaymentMethod", 0.3, "Electronic check"),
        Term("PaperlessBilling", 0.15, "Yes"),
        Term("SeniorCitizen", 0.2),
        Term("Partner", -0.1, "Yes"),
        Term("StreamingTV", 0.05, "Yes"),
    ),
)
TENURE_ONLY = LinearScorer("tenure", 0.25, (Term("tenure", -0.04),))
CONTRACT_ONLY = LinearScorer(
    "contract", -0.25, (Term("Contract", 1.25, "Month-to-month"), Term("Contract", -0.75, "Two year"))
)
CHARGE_ONLY = LinearScorer("charge", -2.0, (Term("MonthlyCharges", 0.025),))
SCORERS = (MAIN, TENURE_ONLY, CONTRACT_ONLY, CHARGE_ONLY)


def score_linear(df: DataFrame, scorer: LinearScorer = MAIN, column: str = "p") -> DataFrame:
    return df.withColumn(column, scorer.probability())


def scored(df: DataFrame, scorer: LinearScorer = MAIN, keep: tuple[str, ...] = ()) -> DataFrame:
    """Evaluation frame: key, score ``p`` and label ``y``; rows without a label are left out."""
    labelled = df.where(F.col(TARGET).isin("Yes", "No"))
    return labelled.select(ID, *keep, scorer.probability().alias("p"), one_zero(TARGET).alias("y"))


def scored_by_all(df: DataFrame, scorers: tuple[LinearScorer, ...] = SCORERS) -> DataFrame:
    """One row per model and customer, from a single scan."""
    entry = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(s.name).alias("model"), s.probability().alias("p"))
            for i, s in enumerate(scorers)
        ]
    )
    labelled = df.where(F.col(TARGET).isin("Yes", "No"))
    return labelled.select(ID, one_zero(TARGET).alias("y"), F.explode(entry).alias("e")).select(ID, "y", "e.*")


def soft_vote(df: DataFrame, columns: tuple[str, ...], column: str = "p") -> DataFrame:
    """Mean of several score columns on the same row."""
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return df.withColumn(column, total / len(columns))
