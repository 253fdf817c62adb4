"""Customer segments: assignment to centroids and the segment tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.schema import NUMERIC

Centroids = Mapping[int, Sequence[float]]


def nearest(centroids: Centroids, values: Sequence[Column]) -> Column:
    """Number of the closest centroid; the lower number wins a tie."""
    options = []
    for cluster, centre in centroids.items():
        distance = F.lit(0.0)
        for value, c in zip(values, centre):
            distance = distance + (value - c) * (value - c)
        options.append(F.struct(distance.alias("d"), F.lit(cluster).alias("c")))
    return F.array_min(F.array(*options))["c"]


def assign_segments(
    df: DataFrame,
    centroids: Centroids,
    columns: Sequence[str] = NUMERIC,
    scaler: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Add ``Cluster``. With a ``scaler`` the centroids are in scaled units."""
    values = [F.col(c) for c in columns]
    if scaler:
        values = [(F.col(c) - scaler[c][0]) / scaler[c][1] for c in columns]
    return df.withColumn("Cluster", nearest(centroids, values))


def segment_profile(df: DataFrame, columns: Sequence[str] = NUMERIC, label: str = "Churn") -> DataFrame:
    """Churn rate, size, share and means per cluster, in one aggregate. Half-even rounding."""
    stats = df.groupBy("Cluster").agg(
        F.bround(F.avg(label), 3).alias("ChurnRate"),
        F.count(F.lit(1)).alias("Count"),
        *[F.bround(F.avg(c), 1).alias(c) for c in columns],
    )
    total = F.sum("Count").over(Window.partitionBy())  # over one line per cluster
    return stats.withColumn("Percentage", F.bround(F.try_divide(F.col("Count"), total) * 100, 1)).select(
        "Cluster", "ChurnRate", "Count", "Percentage", *columns
    )


def segment_risk(profile: DataFrame) -> DataFrame:
    """Weight of every segment (per 1000 customers) beside its churn rate."""
    total = F.sum("Count").over(Window.partitionBy())
    return profile.select(
        "Cluster", "ChurnRate", "Count", (F.try_divide(F.col("Count"), total) * 1000).alias("weight")
    )
