"""CSV, JSON and parquet sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schema import CUSTOMER, REQUEST

_CORRUPT = "_corrupt_record"

# What a reader of the metrics falls back to, number by number.
METRIC_DEFAULTS = {"accuracy": 0.768, "roc_auc": 0.81, "f1_score": 0.54, "precision": 0.57, "recall": 0.50}


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer CSV with a header. Columns go by name, so order and missing optional
    columns do not matter; values that do not fit their type become null."""
    types = {f.name: f.dataType for f in CUSTOMER.fields}
    raw = spark.read.option("header", True).csv(path)
    return raw.select([F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks inside values are kept."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_requests(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Scoring requests: one JSON object per line, or (``lines=False``) whole files that
    hold one object or one list of objects. Text that is neither is an error."""
    if lines:
        return spark.read.schema(REQUEST).json(path)
    schema = T.StructType([*REQUEST.fields, T.StructField(_CORRUPT, T.StringType())])
    frame = spark.read.schema(schema).option("multiLine", True).json(path)
    bad = F.col(_CORRUPT).isNotNull()
    return frame.withColumn(
        _CORRUPT, F.when(bad, F.raise_error(F.lit("Expected a list of customer data")))
    ).where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)


def write_requests(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_payloads(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Request bodies as text in column ``payload``, one per line or one per file, unparsed."""
    return spark.read.text(path, wholetext=not lines).withColumnRenamed("value", "payload")


def write_payloads(payloads: DataFrame, path: str) -> None:
    payloads.select("payload").write.mode("overwrite").text(path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    write_csv(predictions, path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = "customerID string, churn_probability double, predicted_churn int, risk_level string"
    return spark.read.schema(schema).option("header", True).csv(path)


def write_segments(profile: DataFrame, path: str) -> None:
    write_csv(profile, path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "Cluster int, ChurnRate double, Count bigint, Percentage double, "
        "tenure double, MonthlyCharges double, TotalCharges double"
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def write_importance(importance: DataFrame, path: str) -> None:
    write_csv(importance.orderBy(F.col("Importance").desc(), "Feature"), path)


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("Feature string, Importance double").option("header", True).csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The six quality numbers as one JSON record."""
    columns = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "avg_precision")
    metrics.select(*[c for c in columns if c in metrics.columns]).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metrics with the fixed default for each number the file lacks."""
    schema = ", ".join(f"{c} double" for c in (*METRIC_DEFAULTS, "avg_precision"))
    stored = spark.read.schema(schema).json(path)
    return stored.withColumns({c: F.coalesce(c, F.lit(d)) for c, d in METRIC_DEFAULTS.items()})


def write_curve(curve: DataFrame, path: str) -> None:
    curve.write.mode("overwrite").parquet(path)


def read_curve(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
