"""Close neighbours in linear work: hash tables of signed random projections.

The sign of a point's projection on a random direction through the mean is one bit. Each of a
few tables has its own directions, and a bucket holds the points that agree on the first bits
of their signature; where too many agree, further bits split the bucket, so sparse regions keep
short signatures and crowded ones get long ones. Points are compared inside their buckets only.
A point misses a close neighbour only if some direction parts the two in every table.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.neighbours import HIT, matrix, search
from ebbtide.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most points of a bucket, tables, and bits of a signature. Recall is measured in the tests.
BUCKET, TABLES, BITS = 1500, 10, 62


def _signatures(points: DataFrame, tables: int, seed: int) -> DataFrame:
    """(id, table, sign): ``sign`` holds the bits of one table, the first one highest."""
    width = F.size("x")
    means = points.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.avg("v").alias("m")).collect()  # one line per coordinate
    centre = np.array([r["m"] for r in sorted(means)])
    directions = np.random.default_rng(seed).normal(size=(len(centre), tables * BITS))
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            bits = (matrix(batch["x"]) - centre) @ directions > 0
            signs = bits.reshape(len(batch), tables, BITS) @ weights
            yield pd.DataFrame({"id": batch["id"], "signs": list(signs)})

    signs = points.where(width > 0).select("id", "x").mapInPandas(signed, "id bigint, signs array<bigint>")
    return signs.select("id", F.posexplode("signs").alias("table", "sign"))


def _buckets(signed: DataFrame, count: int, bucket: int) -> DataFrame:
    """(id, table, depth, prefix, part): the bucket of each point in each table."""
    start = max(0, math.floor(math.log2(max(1, count / bucket))) - 1)
    placed = materialise(signed.withColumn("depth", F.lit(start)))
    prefix = F.expr(f"shiftright(sign, {BITS} - depth)")
    keys = ["table", "depth", "prefix"]
    while True:
        named = placed.withColumn("prefix", prefix)
        sizes = materialise(named.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket))
        if sizes.where(F.col("depth") < BITS).isEmpty():
            break
        # As many further bits as halving would take: crowded buckets get there in a few rounds.
        more = F.greatest(F.lit(1), F.floor(F.log2(F.col("n") / bucket)).cast("int"))
        deeper = F.least(F.lit(BITS), F.col("depth") + F.coalesce(F.when(F.col("n").isNotNull(), more), F.lit(0)))
        placed = materialise(named.join(sizes, keys, "left").select("id", "table", "sign", deeper.alias("depth")))
    # Points alike in every bit: any of them are close, so parts of bounded size will do.
    parts = F.ceil(F.coalesce("n", F.lit(1)) / bucket).cast("int")
    return named.join(sizes, keys, "left").select("id", *keys, F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))


def close_neighbours(points: DataFrame, k: int, bucket: int = BUCKET, tables: int = TABLES, seed: int = 42) -> DataFrame:
    """(id, hits): ``k`` close other points of each point, nearest first; most of the true ones.

    ``points`` has ``id bigint`` and ``x array<double>``, all ``x`` of one length and best
    distinct, and should be materialised. Up to ``bucket`` points are searched exactly. Beyond
    that a point is compared with at most ``tables * bucket`` others, whatever the size of the
    table, and each of its partial results holds ``k`` hits.
    """
    count = points.count()
    if count <= bucket:
        tables = 1
    placed = _buckets(_signatures(points, tables, seed), count, bucket)
    members = placed.join(points.select("id", "x"), "id")
    keys = ("table", "depth", "prefix", "part")
    found = members.groupBy(*keys).applyInPandas(lambda b: search(b, b, k), f"id bigint, hits {HIT}")
    merged = found.groupBy("id").agg(F.array_distinct(F.array_sort(F.flatten(F.collect_list("hits")))).alias("hits"))
    return merged.select("id", F.slice("hits", 1, k).alias("hits"))
