"""The raw tables and the subscriber table projected from them.

The projection is SQL text: one parse on the JVM side instead of hundreds of column calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only what is read; a given schema also saves the job that would look into the files.
_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
}

# Add-on services: column, multiplier, modulus and number of residues that mean Yes.
_ADDONS = (
    ("OnlineSecurity", 17, 13, 4),
    ("OnlineBackup", 19, 17, 6),
    ("DeviceProtection", 23, 19, 7),
    ("TechSupport", 29, 23, 8),
    ("StreamingTV", 31, 29, 12),
    ("StreamingMovies", 41, 31, 13),
)

_BASE = (
    "c_custkey AS k",
    "last_order",
    "coalesce(n_orders, 0L) AS n_orders",
    "coalesce(n_f, 0L) AS n_f",
    "c_name AS customerID",
    "CAST((c_custkey * 37 + c_nationkey * 11) % 73 AS INT) AS tenure",
    "CASE WHEN c_nationkey % 5 < 2 THEN 'Fiber optic' WHEN c_nationkey % 5 < 4 THEN 'DSL' ELSE 'No' END "
    "AS InternetService",
    "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') THEN 'Month-to-month' "
    "WHEN c_mktsegment = 'FURNITURE' THEN 'One year' ELSE 'Two year' END AS Contract",
    "CAST(1835 + (c_custkey * 7919) % 10040 AS DOUBLE) / 100 AS MonthlyCharges",
)

_COLUMNS = (
    "customerID",
    "if(k % 2 = 0, 'Female', 'Male') AS gender",
    "if(k % 6 = 0, 1, 0) AS SeniorCitizen",
    "if(k % 3 = 0, 'Yes', 'No') AS Partner",
    "if(k % 7 < 2, 'Yes', 'No') AS Dependents",
    "tenure",
    "if(k % 10 = 0, 'No', 'Yes') AS PhoneService",
    "CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN (k * 13) % 11 < 5 THEN 'Yes' ELSE 'No' END AS MultipleLines",
    "InternetService",
    *[
        f"CASE WHEN InternetService = 'No' THEN 'No internet service' "
        f"WHEN (k * {a}) % {m} < {cut} THEN 'Yes' ELSE 'No' END AS {name}"
        for name, a, m, cut in _ADDONS
    ],
    "Contract",
    "if((k * 43) % 5 < 3, 'Yes', 'No') AS PaperlessBilling",
    "CASE (k * 47 + n_orders) % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' "
    "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod",
    "MonthlyCharges",
    "if(tenure = 0, ' ', CAST(CAST(MonthlyCharges * tenure AS DECIMAL(12,2)) AS STRING)) AS TotalCharges",
    "if((k * 53) % 100 < CASE Contract WHEN 'Month-to-month' THEN 40 WHEN 'One year' THEN 12 ELSE 4 END "
    "+ if(InternetService = 'Fiber optic', 10, 0) - if(tenure > 36, 8, 0) + if(2 * n_f > n_orders, 4, 0), "
    "'Yes', 'No') AS Churn",
)

# Requests are the subscriber table as text with six kinds of damage spread through it.
_DAMAGE = {
    "Contract": "if(k % 53 = 1, NULL, Contract)",
    "tenure": "CASE WHEN k % 59 = 2 THEN 'abc' WHEN k % 61 = 3 THEN '-1' ELSE CAST(tenure AS STRING) END",
    "MonthlyCharges": "if(k % 67 = 4, '0', CAST(MonthlyCharges AS STRING))",
    "InternetService": "if(k % 71 = 5, 'Cable', InternetService)",
    "customerID": "if(k % 73 = 6, NULL, customerID)",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(_SCHEMAS[name]) if name in _SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with orders. Partial sums run before the shuffle, so a
    customer holding a large share of all orders costs one row per map task."""
    facts = (
        "count(1) AS n_orders",
        "count_if(o_orderstatus = 'F') AS n_f",
        "max(o_orderdate) AS last_order",
    )
    return table(spark, folder, "orders").groupBy("o_custkey").agg(*map(F.expr, facts))


def subscribers(spark: SparkSession, folder: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Subscriber table with the 21 customer columns, plus ``extra`` helper columns
    (``k``, ``last_order``)."""
    facts = _order_facts(spark, folder).withColumnRenamed("o_custkey", "c_custkey")
    joined = table(spark, folder, "customer").join(facts, "c_custkey", "left")
    return joined.selectExpr(*_BASE).selectExpr(*_COLUMNS, *extra)


def requests(spark: SparkSession, folder: str) -> DataFrame:
    rows = subscribers(spark, folder, extra=("k",))
    kept = [c for c in rows.columns if c not in ("k", "Churn")]
    return rows.selectExpr(*[f"{_DAMAGE[c]} AS {c}" if c in _DAMAGE else c for c in kept])
