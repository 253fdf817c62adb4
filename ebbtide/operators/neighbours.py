"""Exact nearest neighbours of every point among the points of one table.

Points are grouped around pivots. A first round searches a point's own group and yields an
upper bound of its k-th distance; the triangle inequality then names the few other groups
that can still hold a closer point, and a second round searches those. Groups are cut into
blocks, so a task never holds more than two blocks, however crowded a group is.
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

from ebbtide.operators.ranking import seeded_digest
from ebbtide.session import materialise

# The small helpers below travel to the tasks themselves, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_PIVOTS = 1024
HIT = "array<struct<d: double, id: bigint>>"


def matrix(column: pd.Series) -> np.ndarray:
    """An array column as one table of numbers."""
    return np.stack(column.to_numpy()).astype(float)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def search(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k closest points of one block for each query of one block."""
    if queries.empty or points.empty:
        return pd.DataFrame({"id": [], "hits": []})
    x, y = matrix(queries["x"]), matrix(points["x"])
    qid, pid = queries["id"].to_numpy(), points["id"].to_numpy()
    near = _distances(x, y)
    near[qid[:, None] == pid[None, :]] = np.inf
    take = min(k, len(pid))
    best = np.argpartition(near, take - 1, axis=1)[:, :take]
    hits = []
    for row, columns in enumerate(best):
        # Recomputed without the cancellation of the matrix form.
        exact = np.sqrt(((y[columns] - x[row]) ** 2).sum(1))
        hits.append([{"d": d, "id": i} for d, i in zip(exact.tolist(), pid[columns].tolist()) if i != qid[row]])
    return pd.DataFrame({"id": qid, "hits": hits})


def _closest(hits: DataFrame, k: int) -> DataFrame:
    """Merge partial results: the k closest, ties by id."""
    merged = hits.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    return merged.select("id", F.slice("hits", 1, k).alias("hits"))


def nearest_neighbours(points: DataFrame, k: int, block: int = 2000, exact: bool = True, seed: int = 42) -> DataFrame:
    """(id, hits): the ``k`` closest other points of each point, nearest first.

    ``points`` has ``id bigint`` and ``x array<double>``, all ``x`` of one length and best
    distinct, and should be materialised. With ``exact=False`` only the own group is
    searched, which keeps the work linear for very large tables.
    """
    spark = points.sparkSession
    count = points.count()
    wanted = max(1, min(MAX_PIVOTS, math.ceil(count / block)))
    chosen = points.orderBy(seeded_digest("id", seed), "id").limit(wanted).select("x").collect()
    pivots = np.array([row["x"] for row in chosen], dtype=float)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _distances(matrix(batch["x"]), pivots)
                yield batch.assign(cell=away.argmin(1).astype("int32"), r=away.min(1))

    placed = materialise(points.select("id", "x").mapInPandas(place, "id bigint, x array<double>, cell int, r double"))
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("radius")).collect()
    # One entry per pivot, at most MAX_PIVOTS.
    blocks = F.broadcast(
        spark.createDataFrame([(s["cell"], math.ceil(s["n"] / block)) for s in stats], "cell int, blocks int")
    )
    sized = placed.join(blocks, "cell").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def cross_blocks(queries: DataFrame) -> DataFrame:
        """Search ``queries`` (id, x, cell, part) against all points of their cell."""
        left = queries.join(blocks, "cell").select(
            "id", "x", "cell", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own")
        )
        parts = queries.groupBy("cell").agg(F.collect_set("part").alias("parts"))
        # Fresh aliases: both sides may come from the same table.
        right = sized.join(parts, "cell").select(
            *[F.col(c).alias(c) for c in ("id", "x", "cell", "own")], F.explode("parts").alias("part")
        )
        keys = ("cell", "own", "part")
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            lambda q, p: search(q, p, k), f"id bigint, hits {HIT}"
        )
        return found

    first = materialise(
        _closest(cross_blocks(sized.select("id", "x", "cell", F.col("own").alias("part"))), k)
    )
    if not exact or len(pivots) == 1:
        return first

    radius = np.full(len(pivots), -np.inf)
    size = np.zeros(len(pivots))
    for s in stats:
        radius[s["cell"]], size[s["cell"]] = s["radius"], s["n"]
    apart = _distances(pivots, pivots)
    slack = 1e-6  # the matrix form of the distance is not exact to the last digits

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            away = _distances(matrix(batch["x"]), pivots)
            own, reach = batch["cell"].to_numpy(), batch["reach"].to_numpy()
            rows = np.arange(len(batch))
            mine = away[rows, own]
            between = np.maximum(apart[own], 1e-12)
            bound = np.maximum(away - radius[None, :], (away**2 - mine[:, None] ** 2) / (2 * between))
            open_cells = (bound <= reach[:, None] + slack * (1 + reach[:, None])) & (size[None, :] > 0)
            open_cells[rows, own] = False
            row, cell = np.nonzero(open_cells)
            hit = batch.iloc[row]
            yield pd.DataFrame({"id": hit["id"].to_numpy(), "x": hit["x"].to_numpy(), "cell": cell.astype("int32")})

    full = F.size("hits") >= k
    bounded = placed.join(first, "id", "left").select(
        "id", "x", "cell", F.coalesce(F.when(full, F.element_at("hits", -1)["d"]), F.lit(float("inf"))).alias("reach")
    )
    wide = materialise(bounded.mapInPandas(others, "id bigint, x array<double>, cell int"))
    per_cell = wide.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("cuts"))
    queries = wide.join(F.broadcast(per_cell), "cell").select(
        "id", "x", "cell", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias("part")
    )
    return _closest(first.unionByName(cross_blocks(queries)), k)
