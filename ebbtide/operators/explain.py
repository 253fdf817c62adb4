"""Explanation of scores: contributions, dependence curves, permutation importance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.linear import MAIN, LinearScorer
from ebbtide.schema import DOMAINS, ID, literal, quoted

# The plotted ranges and their number of points.
GRIDS = {"tenure": (0.0, 72.0), "MonthlyCharges": (20.0, 120.0)}
GRID_POINTS = 100
CATEGORIES = ("Contract", "InternetService", "PaymentMethod")


def feature_means(df: DataFrame, scorer: LinearScorer = MAIN) -> dict[str, float]:
    row = df.selectExpr(*[f"avg({t.sql})" for t in scorer.terms]).first()
    return {t.name: mean for t, mean in zip(scorer.terms, row)}


def _contributions(df: DataFrame, scorer: LinearScorer) -> dict[str, str]:
    means = feature_means(df, scorer)
    return {
        t.name: f"({t.sql} - CAST('{means[t.name]!r}' AS DOUBLE)) * {t.weight!r}D"
        for t in scorer.terms
        if means[t.name] is not None
    }


def shap_linear_rows(df: DataFrame, scorer: LinearScorer = MAIN, keep: Sequence[str] = (ID,)) -> DataFrame:
    """Contribution of every feature to the row's logit, against the mean row.

    For a linear model the Shapley value is weight * (value - mean), so the contributions
    of a row add up to its logit minus the mean logit.
    """
    return df.selectExpr(*keep, *[f"{sql} AS {quoted(f)}" for f, sql in _contributions(df, scorer).items()])


def shap_linear(df: DataFrame, scorer: LinearScorer = MAIN) -> DataFrame:
    """Mean absolute contribution per feature: the importance of a linear model."""
    spread = _contributions(df, scorer)
    means = df.selectExpr(*[f"avg(abs({sql})) AS {quoted(f)}" for f, sql in spread.items()])
    pairs = ", ".join(f"{literal(f)}, {quoted(f)}" for f in spread)
    return means.selectExpr(f"stack({len(spread)}, {pairs}) AS (Feature, Importance)")


def importance_table(importance: DataFrame) -> DataFrame:
    return importance.orderBy(F.col("Importance").desc(), "Feature")


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance_table(importance).limit(n)


def _grid(feature: str) -> list[float | str]:
    if feature in DOMAINS:
        return list(DOMAINS[feature])
    low, high = GRIDS[feature]
    return [low + i * ((high - low) / (GRID_POINTS - 1)) for i in range(GRID_POINTS)]


def partial_dependence(df: DataFrame, scorer: LinearScorer = MAIN) -> DataFrame:
    """Mean probability with one feature set to each value of its grid, all rows kept.

    A row's logit without the feature is computed once per feature. Each grid value then
    adds a constant, so a cell costs one logistic call. Cells are reduced by partial sums
    in the same task: what is shuffled is one line per grid value and task.
    """
    views = (*GRIDS, *CATEGORIES)
    cells = [(f, value) for f in views for value in _grid(f)]
    entries = [
        f"struct({i} AS cell, {views.index(f)} AS f, "
        f"{sum((t.contribution(v) for t in scorer.terms if t.column == f), 0.0)!r}D AS plus)"
        for i, (f, v) in enumerate(cells)
    ]
    rest = ", ".join(scorer.logit_sql(without=f) for f in views)
    met = df.selectExpr(f"array({rest}) AS rest").selectExpr("rest", f"inline(array({', '.join(entries)}))")
    curve = met.groupBy("cell").agg(F.expr(f"avg({scorer.probability_sql('rest[f] + plus')}) AS probability"))

    def labels(kind: type) -> str:
        shown = [(literal(v) if kind is str else f"{v!r}D") if isinstance(v, kind) else "NULL" for _, v in cells]
        return f"array({', '.join(shown)})[cell]"

    names = f"array({', '.join(literal(f) for f, _ in cells)})[cell]"
    return curve.selectExpr(
        f"{names} AS feature", f"{labels(str)} AS category", f"{labels(float)} AS value", "probability"
    )
