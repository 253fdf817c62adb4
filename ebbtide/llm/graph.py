"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable id for every id of ``links`` (two long columns): ``id``, ``component_id``.

    Alternating stars: every node ties its larger neighbours to the smallest node around it,
    then its smaller ones, until only stars are left. Edges stay rows throughout; each round is
    written to the shared folder, so a lost executor costs one round at most. Ids without
    links are not in the result.
    """
    a, b = links.columns[:2]
    pair = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = materialise(pair.distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(nearest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(edges.select("b", "b").distinct())
