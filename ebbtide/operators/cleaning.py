"""Cleaning, column and feature operators on the customer table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import bands, features
from ebbtide.operators.ranking import exact_median
from ebbtide.schema import ID, NUMERIC, TARGET, literal, quoted


def coerce_numeric(df: DataFrame, columns: Iterable[str] = ("TotalCharges",)) -> DataFrame:
    return df.withColumns({c: bands.number(c) for c in columns})


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null or NaN. One condition per column, so that the scan gets the
    conditions on stored columns and those on columns that are never null disappear."""
    tests = []
    for field in df.schema.fields:
        if subset is None or field.name in subset:
            tests.append(f"{quoted(field.name)} IS NOT NULL")
            if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                tests.append(f"NOT isnan({quoted(field.name)})")
    return df.where(" AND ".join(tests)) if tests else df


def recode_senior(df: DataFrame, column: str = "SeniorCitizen") -> DataFrame:
    return df.withColumn(column, bands.yes_no(column))


def recode_target(df: DataFrame, column: str = TARGET) -> DataFrame:
    return df.withColumn(column, bands.one_zero(column))


def target_to_label(df: DataFrame, column: str = TARGET) -> DataFrame:
    if isinstance(df.schema[column].dataType, T.StringType):
        return df
    return df.withColumn(column, bands.yes_no(column))


def clean_customers(df: DataFrame) -> DataFrame:
    """Numbers parsed, incomplete rows dropped, senior flag as text, target as 1/0.

    Recoding follows the drop, so a value outside the code list ends as null.
    """
    return recode_target(recode_senior(drop_incomplete(coerce_numeric(df))))


def drop_columns(df: DataFrame, columns: Sequence[str] = (ID, TARGET)) -> DataFrame:
    return df.drop(*columns)


def complete_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """The numeric columns as doubles, rows with any gap removed."""
    return drop_incomplete(df.select([bands.number(c).alias(c) for c in columns]))


def default_total_charges(df: DataFrame) -> DataFrame:
    return df.withColumn("TotalCharges", bands.total_charges_or_default())


def with_expressions(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add or replace columns given as SQL text."""
    kept = [f"({columns[c]}) AS {quoted(c)}" if c in columns else quoted(c) for c in df.columns]
    added = [f"({sql}) AS {quoted(c)}" for c, sql in columns.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)


def create_features(df: DataFrame, median: float | None = None) -> DataFrame:
    """Add the engineered columns.

    ``median`` is the median monthly charge; it is measured on ``df`` unless a fitted
    value is passed. Service features are left out of a table that is already encoded.
    """
    if "InternetService_No" in df.columns:
        return with_expressions(df, {**features.SPEND_RATIOS, "Tenure_Bucket": features.TENURE_BUCKET})
    with_senior = "SeniorCitizen" in df.columns
    if with_senior and median is None:
        median = exact_median(df, "MonthlyCharges")
    text = with_senior and isinstance(df.schema["SeniorCitizen"].dataType, T.StringType)
    return with_expressions(df, features.engineered(median, text, with_senior))


def one_hot_drop_first(df: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
    """Featured table to the 46 model columns, first level of every category left out."""
    coded = [f"{sql} AS {quoted(name)}" for name, sql in features.dummies().items()]
    return df.selectExpr(*keep, *features.PLAIN, *coded)


def one_hot_align(
    df: DataFrame, expected: Sequence[str] = features.MODEL_COLUMNS, keep: Sequence[str] = (ID,)
) -> DataFrame:
    """Encode whatever ``df`` has into the ``expected`` columns.

    A numeric or boolean column passes through, ``column_value`` is encoded from a text
    column, and everything else is 0.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    text = sorted((c for c, t in types.items() if isinstance(t, T.StringType)), key=len, reverse=True)
    out, found = [], 0
    for name in expected:
        source = next((c for c in text if name.startswith(c + "_")), None)
        if name in types and name not in text:
            sql, known = quoted(name), True
        elif source is not None:
            sql, known = f"CAST({quoted(source)} <=> {literal(name[len(source) + 1 :])} AS INT)", True
        else:
            sql, known = "0", False
        out.append(f"{sql} AS {quoted(name)}")
        found += known
    if not found:
        raise ValueError("No matching columns found between the data and the model's expected columns.")
    return df.selectExpr(*[quoted(c) for c in keep if c in types], *out)


def select_important(df: DataFrame, keep: Sequence[str] = (ID,)) -> DataFrame:
    """The short feature list, taken after full encoding (every level has a column)."""
    coded = features.dummies(drop_first=False)
    return df.selectExpr(*keep, *[f"{coded.get(name, quoted(name))} AS {quoted(name)}" for name in features.IMPORTANT])


def fit_scaler(df: DataFrame, columns: Sequence[str] = features.MODEL_COLUMNS) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate row."""
    values = [f"CAST({quoted(c)} AS DOUBLE)" for c in columns]
    row = df.selectExpr(*[f"avg({v})" for v in values], *[f"stddev_pop({v})" for v in values]).first()
    return {c: (row[i], row[len(columns) + i] or 1.0) for i, c in enumerate(columns)}


def scaled_expressions(scaler: dict[str, tuple[float, float]]) -> dict[str, str]:
    return {
        name: f"(CAST({quoted(name)} AS DOUBLE) - CAST('{mean!r}' AS DOUBLE)) / CAST('{std!r}' AS DOUBLE)"
        for name, (mean, std) in scaler.items()
    }


def standard_scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return with_expressions(df, scaled_expressions(scaler))


def charge_scatter(df: DataFrame) -> DataFrame:
    """Points of the tenure against charge plot, one class each."""
    return df.where(F.col(TARGET).isin("Yes", "No")).select(TARGET, "tenure", "MonthlyCharges")


def binned_scatter(df: DataFrame, tenure_step: int = 3, charge_step: int = 5) -> DataFrame:
    """The same plot as counts per cell: its size no longer grows with the table."""
    return (
        charge_scatter(df)
        .groupBy(
            TARGET,
            (F.floor(F.col("tenure") / tenure_step) * tenure_step).alias("tenure"),
            (F.floor(F.col("MonthlyCharges") / charge_step) * charge_step).alias("MonthlyCharges"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
