"""Names, types and value domains of the subscriber table."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "customerID"
TARGET = "Churn"
NUMERIC = ("tenure", "MonthlyCharges", "TotalCharges")

# The domain of every categorical column, each in alphabetical order
# (the first entry is the level that drop-first encoding leaves out).
DOMAINS: dict[str, tuple[str, ...]] = {
    "gender": ("Female", "Male"),
    "SeniorCitizen": ("No", "Yes"),
    "Partner": ("No", "Yes"),
    "Dependents": ("No", "Yes"),
    "PhoneService": ("No", "Yes"),
    "MultipleLines": ("No", "No phone service", "Yes"),
    "InternetService": ("DSL", "Fiber optic", "No"),
    "OnlineSecurity": ("No", "No internet service", "Yes"),
    "OnlineBackup": ("No", "No internet service", "Yes"),
    "DeviceProtection": ("No", "No internet service", "Yes"),
    "TechSupport": ("No", "No internet service", "Yes"),
    "StreamingTV": ("No", "No internet service", "Yes"),
    "StreamingMovies": ("No", "No internet service", "Yes"),
    "Contract": ("Month-to-month", "One year", "Two year"),
    "PaperlessBilling": ("No", "Yes"),
    "PaymentMethod": (
        "Bank transfer (automatic)",
        "Credit card (automatic)",
        "Electronic check",
        "Mailed check",
    ),
}

# The nine columns that count as services.
SERVICES = (
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)

# Column order of the source file.
COLUMNS = (
    ID,
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    *SERVICES,
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "MonthlyCharges",
    "TotalCharges",
    TARGET,
)

_TYPES = {"SeniorCitizen": T.IntegerType(), "tenure": T.IntegerType(), "MonthlyCharges": T.DoubleType()}

CUSTOMER = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in COLUMNS])

# A scoring request has no label. Its numbers stay text so that a bad value reaches the
# validators instead of nulling the whole record.
REQUEST = T.StructType(
    [
        T.StructField(c, T.StringType() if c in NUMERIC else _TYPES.get(c, T.StringType()))
        for c in COLUMNS
        if c != TARGET
    ]
)


def quoted(name: str) -> str:
    """Column name as it has to appear inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """Text constant as it has to appear inside SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
