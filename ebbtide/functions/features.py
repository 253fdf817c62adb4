"""Feature expressions over one customer row.

They are kept as SQL text because a fitted pipeline stores them in ``SQLTransformer``
stages; the DataFrame operators use the same text through ``expr``.
"""

from __future__ import annotations

from ebbtide.schema import DOMAINS, SERVICES, literal, quoted

# Fixed values: (exclusive lower edge, inclusive upper edge, label).
TENURE_BUCKETS = (
    (0, 6, "0-6mo"),
    (6, 12, "6-12mo"),
    (12, 24, "1-2yr"),
    (24, 36, "2-3yr"),
    (36, 60, "3-5yr"),
    (60, None, "5yr+"),
)
TENURE_GROUPS = (
    (0, 12, "0-12"),
    (12, 24, "13-24"),
    (24, 36, "25-36"),
    (36, 60, "37-60"),
    (60, 72, "61-72"),
)


def interval_label(column: str, edges) -> str:
    """Label of the half-open interval (low, high] that holds the value, else null."""
    arms = []
    for low, high, label in edges:
        bound = f"{column} > {low}" + ("" if high is None else f" AND {column} <= {high}")
        # Spark orders NaN above every number; it belongs to no interval.
        arms.append(f"WHEN {bound} AND NOT isnan({column}) THEN {literal(label)}")
    return f"CASE {' '.join(arms)} END"


def interval_rank(column: str, edges) -> str:
    """Position of a label inside its ordered category."""
    arms = " ".join(f"WHEN {literal(label)} THEN {i}" for i, (_, _, label) in enumerate(edges))
    return f"CASE {column} {arms} END"


TENURE_BUCKET = interval_label("tenure", TENURE_BUCKETS)
TENURE_GROUP = interval_label("tenure", TENURE_GROUPS)

SERVICE_COUNT = " + ".join(f"CAST({c} <=> 'Yes' AS INT)" for c in SERVICES)
SPEND_RATIOS = {
    "AvgMonthlySpend": "try_divide(TotalCharges, tenure + 1)",
    "Revenue_per_Tenure": "try_divide(MonthlyCharges, tenure + 1)",
}
SERVICE_FLAGS = {
    "HasInternetService": "NOT (InternetService <=> 'No')",
    "HasPhoneService": "PhoneService <=> 'Yes'",
    "IsMonthToMonth": "Contract <=> 'Month-to-month'",
}
COST_PER_SERVICE = f"MonthlyCharges / ({SERVICE_COUNT} + 1)"
CONTRACT_TENURE = "tenure * CAST(Contract <=> 'Month-to-month' AS INT)"
NO_SECURITY = "CAST(OnlineSecurity <=> 'No' AND OnlineBackup <=> 'No' AND DeviceProtection <=> 'No' AS INT)"
HIGH_RISK_PAYMENT = "CAST(PaymentMethod <=> 'Electronic check' AND Contract <=> 'Month-to-month' AS INT)"


def senior_high_charge(median: float | None, senior_is_text: bool) -> str:
    """Senior customer paying more than the median of the whole table."""
    senior = "SeniorCitizen <=> 'Yes'" if senior_is_text else "SeniorCitizen <=> 1"
    if median is None:
        return "0"
    over = f"coalesce(MonthlyCharges > CAST('{median!r}' AS DOUBLE) AND NOT isnan(MonthlyCharges), false)"
    return f"CAST({senior} AND {over} AS INT)"


def engineered(median: float | None, senior_is_text: bool, with_senior: bool = True) -> dict[str, str]:
    """Every engineered column, in the order the model layout lists them."""
    columns = {
        **SPEND_RATIOS,
        "Tenure_Bucket": TENURE_BUCKET,
        "ServiceCount": SERVICE_COUNT,
        "Cost_per_Service": COST_PER_SERVICE,
        **SERVICE_FLAGS,
        "Contract_Tenure": CONTRACT_TENURE,
        "NoSecurity": NO_SECURITY,
        "HighRiskPayment": HIGH_RISK_PAYMENT,
    }
    if with_senior:
        columns["Senior_HighCharge"] = senior_high_charge(median, senior_is_text)
    return columns


# Columns that enter the model unencoded, in order.
PLAIN = (
    "tenure",
    "MonthlyCharges",
    "TotalCharges",
    "AvgMonthlySpend",
    "Revenue_per_Tenure",
    "ServiceCount",
    "Cost_per_Service",
    "HasInternetService",
    "HasPhoneService",
    "IsMonthToMonth",
    "Contract_Tenure",
    "NoSecurity",
    "HighRiskPayment",
    "Senior_HighCharge",
)
LEVELS: dict[str, tuple[str, ...]] = {
    **DOMAINS,
    "Tenure_Bucket": tuple(label for _, _, label in TENURE_BUCKETS),
}

# The short list of features judged most useful.
IMPORTANT = (
    "Contract_Month-to-month",
    "tenure",
    "TotalCharges",
    "MonthlyCharges",
    "InternetService_Fiber optic",
    "PaymentMethod_Electronic check",
    "OnlineSecurity_No",
    "TechSupport_No",
    "PaperlessBilling_Yes",
    "Contract_Two year",
    "Revenue_per_Tenure",
    "ServiceCount",
    "NoSecurity",
    "HighRiskPayment",
    "Contract_Tenure",
)


def dummies(drop_first: bool = True) -> dict[str, str]:
    """One 0/1 column per category level; ``column_level`` names."""
    return {
        f"{column}_{level}": f"CAST({quoted(column)} <=> {literal(level)} AS INT)"
        for column, levels in LEVELS.items()
        for level in levels[1 if drop_first else 0 :]
    }


MODEL_COLUMNS = (*PLAIN, *dummies())
