"""Synthetic minority rows: points on the segment between a row and a close neighbour."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.hashing import close_neighbours
from ebbtide.operators.neighbours import nearest_neighbours
from ebbtide.operators.ranking import running_totals
from ebbtide.operators.sampling import SEED, undersample
from ebbtide.session import materialise

NEIGHBOURS = 5  # fixed value: neighbours considered per row
_CHUNK = 10_000


def _uniform(*parts) -> Column:
    """Number in [0, 1) that depends on its arguments only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def _numbered(counted: DataFrame) -> DataFrame:
    """Distinct vectors with an id made from their values, so that runs repeat. Should two
    vectors ever share a hash, another one is used."""
    for salt in itertools.count():
        points = materialise(counted.select(F.xxhash64("x", F.lit(salt)).alias("id"), "x", "m"))
        if points.groupBy("id").count().where("count > 1").isEmpty():
            return points


def oversample_smote(
    df: DataFrame, features: str = "features", label: str = "label", k: int = NEIGHBOURS, seed: int = SEED, exact: bool = False
) -> DataFrame:
    """(features, label) of all rows plus synthetic minority rows until the classes are
    equal. ``features`` is an array of doubles. See :func:`synthetic_rows`."""
    data = df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"))
    made = synthetic_rows(df, features, label, k, seed, exact)
    return data if made is None else data.unionByName(made.select("features", "label"))


def synthetic_rows(
    df: DataFrame, features: str = "features", label: str = "label", k: int = NEIGHBOURS, seed: int = SEED, exact: bool = False
) -> DataFrame | None:
    """(features, label, x, y, gap): the rows missing in the minority class, each at ``gap``
    of the way from the row ``x`` to one of its ``k`` neighbours ``y``. None if none is missing.

    Neighbours come from hash tables, in work linear in the minority class; ``exact`` searches
    for the true ones, whose cost grows faster. Copies of a row are counted first: equal
    vectors are searched once, and a vector with many copies has its own copies as closest
    neighbours. Every row receives its share of new rows by rounding a running total, so the
    number of new rows is exact.
    """
    data = df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"))
    sizes = {row["label"]: row["count"] for row in data.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    minority = min(sizes, key=lambda c: (sizes[c], -c))
    missing, rows = max(sizes.values()) - sizes[minority], sizes[minority]
    if missing == 0 or rows < 2:
        return None

    counted = materialise(
        data.where(F.col("label") == minority).groupBy(F.col("features").alias("x")).agg(F.count(F.lit(1)).alias("m"))
    )
    points = _numbered(counted)
    # Vectors with more than k copies are searched too: others may have them as neighbours.
    search = nearest_neighbours if exact else close_neighbours
    near = search(points.select("id", "x"), k, seed=seed)

    totals = running_totals(points.select("id", "m"), "id", ["m"], descending=False)

    def upto(total: str) -> str:
        # In decimals: the product of two row counts can exceed 64 bits.
        product = f"CAST({total} AS DECIMAL(19,0)) * CAST({missing} AS DECIMAL(18,0))"
        return f"({product}) div CAST({rows} AS DECIMAL(18,0))"

    quota = totals.select("id", F.expr(f"{upto('cum_m')} - {upto('cum_m - m')}").alias("quota"))
    quota = quota.where(F.col("quota") > 0)

    # Neighbour list of a point: its own copies first (0), then the others in order, each
    # as often as it has copies. ``ys`` holds the neighbours' vectors, so the new rows need
    # no further join, whose hot key would be the most copied vector.
    copies = points.select(F.col("id").alias("other"), F.col("m").alias("other_m"), F.col("x").alias("y"))
    others = (
        near.select("id", F.posexplode("hits").alias("rank", "hit"))
        .select("id", "rank", F.col("hit.id").alias("other"))
        .join(copies, "other")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "other_m", "y"))).alias("found"))
    )

    def times(index, count):
        return F.array_repeat(index.cast("int"), F.least(count, F.lit(k)).cast("int"))

    none = F.array().cast("array<int>")
    rest = F.flatten(F.transform("found", lambda f, i: times(i + 1, f["other_m"])))
    choices = F.slice(F.concat(times(F.lit(0), F.col("m") - 1), F.coalesce(rest, none)), 1, k)
    lists = points.join(others, "id", "left").select("id", "x", choices.alias("choices"), F.col("found.y").alias("ys"))

    # A large quota is handed out in chunks, so one much copied vector fills many tasks.
    chunks = F.sequence(F.lit(0), F.floor((F.col("quota") - 1) / _CHUNK))
    spread = lists.join(quota, "id").withColumn("chunk", F.explode(chunks)).repartition("id", "chunk")
    first, last = F.col("chunk") * _CHUNK + 1, F.least((F.col("chunk") + 1) * _CHUNK, F.col("quota"))
    draws = spread.withColumn("draw", F.explode(F.sequence(first, last)))
    place = (F.floor(_uniform("id", "draw", F.lit(seed)) * F.size("choices")) + 1).cast("int")
    chosen = F.element_at("choices", place)
    picked = draws.select(
        "x",
        F.when(chosen == 0, F.col("x")).otherwise(F.get("ys", chosen - 1)).alias("y"),
        _uniform("draw", "id", F.lit(seed + 1)).alias("gap"),
    )
    return picked.select(
        F.zip_with("x", "y", lambda a, b: a + F.col("gap") * (b - a)).alias("features"),
        F.lit(float(minority)).alias("label"),
        "x",
        "y",
        "gap",
    )


def balance(df: DataFrame, method: str = "smote", key: str = "row_key", seed: int = SEED, exact: bool = False) -> DataFrame:
    """Balance a (key, features, label) frame; an unknown method leaves it as it is.

    ``smote`` adds rows (``exact`` as in :func:`oversample_smote`), ``undersampling`` removes rows, and ``class_weight`` keeps the rows
    because the weights are applied while fitting.
    """
    if method == "smote":
        return oversample_smote(df, seed=seed, exact=exact)
    if method == "undersampling":
        return undersample(df, key=key, target="label", seed=seed).select("features", "label")
    return df.select("features", "label")
