"""Cleaning, banding and rule expressions over one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH_RISK, MEDIUM_RISK = 0.7, 0.3


def number(column: str | Column) -> Column:
    """Text to double; what does not parse becomes null, and so does NaN.

    Spark also reads Java's type suffixes (``1.0d``); those are not numbers here.
    """
    c = F.col(column) if isinstance(column, str) else column
    plain = ~c.cast("string").rlike(r"[0-9.][dDfF]\s*$")
    return F.nanvl(F.when(plain, c.try_cast("double")), F.lit(None).cast("double"))


def yes_no(column: str) -> Column:
    """1 to Yes, 0 to No, anything else to null."""
    c = F.col(column)
    return F.when(c == 1, "Yes").when(c == 0, "No")


def one_zero(column: str) -> Column:
    """Yes to 1, No to 0, anything else to null."""
    c = F.col(column)
    return F.when(c == "Yes", 1).when(c == "No", 0)


def total_charges_or_default() -> Column:
    """Total charges, or what the tenure implies when none is recorded."""
    return F.coalesce(number("TotalCharges"), number("MonthlyCharges") * number("tenure"))


def risk_level(probability: str | Column) -> Column:
    """Band of a probability; none where it is null or NaN."""
    p = F.col(probability) if isinstance(probability, str) else probability
    p = F.nanvl(p, F.lit(None).cast("double"))
    return F.when(p > HIGH_RISK, "High").when(p > MEDIUM_RISK, "Medium").when(p.isNotNull(), "Low")


def risk_factors() -> Column:
    """Array of the reasons that apply to the row, in a fixed order."""
    online = ~F.col("InternetService").eqNullSafe("No")
    # The rule texts.
    rules = (
        (F.col("Contract") == "Month-to-month", "Month-to-month contract"),
        (F.col("InternetService") == "Fiber optic", "Fiber optic internet service"),
        (F.col("PaymentMethod") == "Electronic check", "Electronic check payment method"),
        (F.col("tenure") < 12, "Customer tenure less than 1 year"),
        ((F.col("OnlineSecurity") == "No") & online, "No online security service"),
        ((F.col("TechSupport") == "No") & online, "No technical support"),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in rules]))


# Suggested actions for customers predicted to leave (1) or to stay (0).
ACTIONS = {
    1: (
        "Offer a promotion for upgrading to a longer-term contract",
        "Provide discounted security and support services",
        "Consider a loyalty program or special pricing",
    ),
    0: (
        "Regular check-ins to ensure continued satisfaction",
        "Cross-sell additional services",
        "Highlight long-term benefits of current subscription",
    ),
}


def actions(predicted: str) -> Column:
    """Array of the actions for the predicted class."""
    chosen = F.when(F.col(predicted) == 1, F.array(*map(F.lit, ACTIONS[1])))
    return chosen.when(F.col(predicted) == 0, F.array(*map(F.lit, ACTIONS[0])))
