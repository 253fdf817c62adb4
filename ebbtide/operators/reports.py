"""KPI, crosstab, lifetime-value and correlation reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import features
from ebbtide.operators.cleaning import complete_numeric
from ebbtide.schema import NUMERIC, TARGET

NO_CHURN_LIFETIME = 60


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def churn_kpis(df: DataFrame) -> DataFrame:
    """Headline numbers, all from one pass over the table."""
    churned = F.col(TARGET) == "Yes"
    first_year = (F.col("Contract") == "Month-to-month") & (F.col("tenure") < 12)
    totals = df.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(churned).alias("churned"),
        F.coalesce(F.sum("MonthlyCharges"), F.lit(0.0)).alias("monthly_revenue"),
        F.coalesce(F.sum(F.when(churned, F.col("MonthlyCharges"))), F.lit(0.0)).alias("at_risk_revenue"),
        F.count_if(first_year).alias("first_year_monthly"),
        F.avg("tenure").alias("avg_tenure"),
        F.avg("MonthlyCharges").alias("avg_monthly"),
    )
    return totals.withColumns(
        {
            "churn_rate": _percent(F.col("churned"), F.col("customers")),
            "at_risk_share": _percent(F.col("at_risk_revenue"), F.col("monthly_revenue")),
        }
    )


def churn_distribution(df: DataFrame) -> DataFrame:
    """Count and percent per class; null classes are left out."""
    counts = df.where(F.col(TARGET).isNotNull()).groupBy(TARGET).agg(F.count(F.lit(1)).alias("customers"))
    # The window runs over the class counts, not over rows.
    total = F.sum("customers").over(Window.partitionBy())
    return counts.withColumn("percent", _percent(F.col("customers"), total))


def crosstab_rate(
    df: DataFrame, row: str, target: str = TARGET, values: Sequence[str] = ("No", "Yes")
) -> DataFrame:
    """Row-normalised crosstab in percent: one line per ``row`` value, one column per class.

    Conditional counts keep it to a single partial aggregate, so a value shared by most
    rows costs no more than any other.
    """
    known = df.where(F.col(row).isNotNull() & F.col(target).isNotNull())
    counts = known.groupBy(row).agg(
        F.count(F.lit(1)).alias("customers"), *[F.count_if(F.col(target) == v).alias(v) for v in values]
    )
    return counts.select(row, "customers", *[_percent(F.col(v), F.col("customers")).alias(v) for v in values])


def churn_rate_by(df: DataFrame, row: str) -> DataFrame:
    """Percent of churners per ``row`` value."""
    return crosstab_rate(df, row).select(row, F.col("Yes").alias("churn_rate"))


def churn_by_tenure_group(df: DataFrame) -> DataFrame:
    grouped = df.withColumn("tenure_group", F.expr(features.TENURE_GROUP))
    rank = F.expr(features.interval_rank("tenure_group", features.TENURE_GROUPS))
    return churn_rate_by(grouped, "tenure_group").withColumn("position", rank).orderBy("position")


def lifetime_value(df: DataFrame, by: str = "Contract") -> DataFrame:
    """Expected lifetime and value per group: the lifetime is one over the churn rate."""
    stats = (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(
            F.avg("MonthlyCharges").alias("avg_monthly"),
            F.coalesce(F.avg(F.when(F.col(TARGET).isNotNull(), (F.col(TARGET) == "Yes").cast("int"))), F.lit(0.0)).alias(
                "churn_rate"
            ),
            F.avg("tenure").alias("avg_tenure"),
        )
    )
    lifetime = F.when(F.col("churn_rate") > 0, 1 / F.col("churn_rate")).otherwise(float(NO_CHURN_LIFETIME))
    return stats.withColumn("lifetime_months", lifetime).withColumn(
        "lifetime_value", F.col("avg_monthly") * F.col("lifetime_months")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Pearson correlation of the complete rows; each pair is measured once."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = complete_numeric(df, columns).agg(
        F.count(F.lit(1)).alias("n"), *[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs]
    )

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.when(F.col("n") > 0, F.lit(1.0))
        return F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")

    lines = [F.struct(F.lit(a).alias("feature"), *[cell(a, b).alias(b) for b in columns]) for a in columns]
    return row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def observed_dependence(df: DataFrame) -> DataFrame:
    """Observed churn rate per value of the five features whose effect is plotted.

    Tenure is taken per month and the charge per ten units. All five come from one pass.
    """
    charge = (F.floor(F.col("MonthlyCharges") / 10) * 10).cast("string")
    views = {
        "tenure": F.col("tenure").cast("string"),
        "MonthlyCharges": charge,
        "Contract": F.col("Contract"),
        "InternetService": F.col("InternetService"),
        "PaymentMethod": F.col("PaymentMethod"),
    }
    entry = F.array(*[F.struct(F.lit(n).alias("feature"), v.alias("value")) for n, v in views.items()])
    long = df.where(F.col(TARGET).isNotNull()).select(TARGET, F.explode(entry).alias("e"))
    return (
        long.where(F.col("e.value").isNotNull())
        .groupBy(F.col("e.feature").alias("feature"), F.col("e.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("customers"), F.avg((F.col(TARGET) == "Yes").cast("int")).alias("churn_rate"))
    )
