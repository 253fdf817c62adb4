"""Filters and validators. A validator adds an error column; nothing is raised per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.bands import number
from ebbtide.schema import DOMAINS, ID

# Required fields and the message texts.
STRICT_FIELDS = ("tenure", "MonthlyCharges", "InternetService", "Contract", "PaymentMethod")
LENIENT_FIELDS = ("tenure", "MonthlyCharges", "Contract")
MISSING = "Missing required fields: "
VALID = "Data is valid"
STRICT_MESSAGES = (
    "Tenure must be a non-negative number",
    "MonthlyCharges must be a positive number",
    "Contract must be 'Month-to-month', 'One year', or 'Two year'",
    "InternetService must be 'DSL', 'Fiber optic', or 'No'",
)
LENIENT_MESSAGES = ("Tenure must be a number", "MonthlyCharges must be a number")


def filter_customers(df: DataFrame, contracts: Sequence[str], services: Sequence[str]) -> DataFrame:
    """Rows in both lists; an empty list on either side switches filtering off."""
    if not contracts or not services:
        return df
    return df.where(F.col("Contract").isin(*contracts) & F.col("InternetService").isin(*services))


def filter_counts(df: DataFrame, contracts: Sequence[str], services: Sequence[str]) -> DataFrame:
    """How many rows the filter shows, and of how many, in one pass."""
    test = F.lit(True)
    if contracts and services:
        test = F.col("Contract").isin(*contracts) & F.col("InternetService").isin(*services)
    return df.agg(F.count_if(test).alias("shown"), F.count(F.lit(1)).alias("total"))


def filter_options(df: DataFrame, columns: Sequence[str] = ("Contract", "InternetService")) -> DataFrame:
    """Sorted distinct values of each filter column, all columns in one pass."""
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("option")) for c in columns]))
    return df.select(entry.alias("e")).select("e.*").distinct().orderBy("column", "option")


def first_year_monthly(df: DataFrame) -> DataFrame:
    return df.where((F.col("Contract") == "Month-to-month") & (F.col("tenure") < 12))


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def _numeric(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return number(c) if _is_text(df, column) else F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def _strict_checks(df: DataFrame) -> list[Column]:
    return [
        _numeric(df, "tenure") >= 0,
        _numeric(df, "MonthlyCharges") > 0,
        F.col("Contract").isin(*DOMAINS["Contract"]),
        F.col("InternetService").isin(*DOMAINS["InternetService"]),
    ]


def _lenient_checks(df: DataFrame) -> list[Column]:
    return [_numeric(df, "tenure").isNotNull(), _numeric(df, "MonthlyCharges").isNotNull()]


def _rules(df: DataFrame, strict: bool):
    fields, messages = (STRICT_FIELDS, STRICT_MESSAGES) if strict else (LENIENT_FIELDS, LENIENT_MESSAGES)
    absent = [c for c in fields if c not in df.columns]
    checks = [] if absent else (_strict_checks(df) if strict else _lenient_checks(df))
    return fields, messages, absent, checks


def _error(df: DataFrame, strict: bool) -> Column:
    """First failing message of the row, null when the row is fine. A null in a required
    field counts as a field the record did not send."""
    fields, messages, absent, checks = _rules(df, strict)
    if absent:
        return F.lit(MISSING + ", ".join(absent))
    gaps = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in fields])
    arms = [F.when(gaps != "", F.concat(F.lit(MISSING), gaps))]
    arms += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in zip(checks, messages)]
    return F.coalesce(*arms)


def validate_strict(df: DataFrame, column: str = "error") -> DataFrame:
    return df.withColumn(column, _error(df, strict=True))


def validate_lenient(df: DataFrame, column: str = "error") -> DataFrame:
    return df.withColumn(column, _error(df, strict=False))


def validate_frame(df: DataFrame, strict: bool = True) -> DataFrame:
    """One verdict for the whole table: (is_valid, message). An empty table is valid."""
    _, messages, absent, checks = _rules(df, strict)
    if absent:
        text = MISSING + ", ".join(absent)
        return df.sparkSession.createDataFrame([(False, text)], "is_valid boolean, message string")
    holds = [F.coalesce(F.bool_and(F.coalesce(ok, F.lit(False))), F.lit(True)) for ok in checks]
    verdict = df.agg(*[h.alias(f"ok{i}") for i, h in enumerate(holds)])
    message = F.coalesce(*[F.when(~F.col(f"ok{i}"), F.lit(m)) for i, m in enumerate(messages)], F.lit(VALID))
    return verdict.select((message == VALID).alias("is_valid"), message.alias("message"))


def check_frame(df: DataFrame, strict: bool = True, raise_exception: bool = True) -> tuple[bool, str]:
    """Driver-side form of :func:`validate_frame`; raises ``ValueError`` on request."""
    row = validate_frame(df, strict).first()
    if raise_exception and not row["is_valid"]:
        raise ValueError(row["message"])
    return row["is_valid"], row["message"]


def split_valid(df: DataFrame, strict: bool = False) -> DataFrame:
    """All records with ``customer_id`` and ``error``; one pass, no union of two halves."""
    known = F.col(ID) if ID in df.columns else F.lit(None).cast("string")
    return df.withColumns({"customer_id": F.coalesce(known, F.lit("Unknown")), "error": _error(df, strict)})
