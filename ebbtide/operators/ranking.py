"""Running totals, exact medians and exact-size cuts without a single-task sort.

Every helper works on value counts or on a hash, so rows that share a value are
pre-aggregated before anything is shuffled, and the tables that reach the driver have a
fixed upper size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.session import materialise

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 4096

_DIGITS = 32  # of a digest
_CELL_DIGITS = 4  # 65,536 cells per level
_RANK_LIMIT = 100_000


def running_totals(
    counts: DataFrame,
    key: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Add ``cum_<s>``, the inclusive running total of each ``s`` in ``key`` order.

    ``counts`` holds one row per (``by``, ``key``) and should be materialised, since it is
    read several times. Keys are cut into ranges of about equal row count; each range is
    summed on its own and shifted by the total of the ranges before it. Adds ``next_<s>``
    as well: the value of ``s`` at the following key (null at the last one).
    """
    by = list(by)
    # One rule at every size: a key without a place in the order is left out.
    counts = counts.where(F.nanvl(F.col(key).cast("double"), F.lit(None).cast("double")).isNotNull())
    buckets = min(MAX_BUCKETS, math.ceil(counts.count() / rows_per_bucket))
    order = F.col(key).desc() if descending else F.col(key).asc()
    if buckets > 1:
        marks = [i / buckets for i in range(1, buckets)]
        cuts = counts.agg(F.percentile_approx(key, marks, 20 * buckets)).first()[0]
        splits = [-math.inf, *sorted({float(c) for c in cuts}), math.inf]
        ranged = Bucketizer(splits=splits, inputCol=key, outputCol="_range").transform(counts)
    else:
        ranged = counts.withColumn("_range", F.lit(0.0))
    inside = Window.partitionBy(*by, "_range").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns(
        {f"cum_{s}": F.sum(s).over(upto) for s in sums} | {f"next_{s}": F.lead(s).over(inside) for s in sums}
    )
    if buckets <= 1:
        return summed.drop("_range")

    # At most MAX_BUCKETS rows per group: the window over them stays small.
    pick = F.max_by if descending else F.min_by
    totals = ranged.groupBy(*by, "_range").agg(
        *[F.sum(s).alias(f"_total_{s}") for s in sums], *[pick(s, key).alias(f"_first_{s}") for s in sums]
    )
    step = F.col("_range").desc() if descending else F.col("_range").asc()
    across = Window.partitionBy(*by).orderBy(step)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_total_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.lead(f"_first_{s}").over(across).alias(f"_after_{s}") for s in sums],
    )
    joined = summed.join(offsets, [*by, "_range"])
    return joined.withColumns(
        {f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_before_{s}") for s in sums}
        | {f"next_{s}": F.coalesce(f"next_{s}", f"_after_{s}") for s in sums}
    ).select(*counts.columns, *[f"cum_{s}" for s in sums], *[f"next_{s}" for s in sums])


def exact_median(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> float | None:
    """Median of the non-missing values, found from value counts."""
    value = F.col(column).cast("double")
    counts = materialise(
        df.select(value.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return None
    ranked = running_totals(counts, "value", ["n"], descending=False, rows_per_bucket=rows_per_bucket)
    low, high = (total - 1) // 2, total // 2
    start = F.col("cum_n") - F.col("n")
    ends = ranked.agg(
        F.max(F.when((start <= low) & (F.col("cum_n") > low), F.col("value"))),
        F.max(F.when((start <= high) & (F.col("cum_n") > high), F.col("value"))),
    ).first()
    return (ends[0] + ends[1]) / 2


def median_sketches(df: DataFrame, column: str, by: Sequence[str] = (), size: int = 2000) -> DataFrame:
    """``by``, ``sketch`` and the number ``n`` of non-missing values it stands for.

    KLL sketches of a fixed size: store them with a part of a table, and the median of any
    union of parts follows from :func:`merged_median` without reading the parts again.
    """
    value = F.col(column).cast("double")
    known = df.select(*by, F.nanvl(value, F.lit(None).cast("double")).alias("_v")).where("_v is not null")
    return known.groupBy(*by).agg(F.kll_sketch_agg_double("_v", size).alias("sketch"), F.count("_v").alias("n"))


def merged_median(sketches: DataFrame, size: int = 2000) -> float | None:
    """Median by the union of ``sketches``; its rank is right to about 2.3 / ``size``^0.9."""
    merged = sketches.where("n > 0").agg(F.kll_merge_agg_double("sketch", size).alias("s"), F.sum("n").alias("n"))
    return merged.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(0.5)))).first()[0]


def seeded_digest(key: str | Column, seed: int = 42) -> Column:
    """Hex digest that orders rows at random but repeats from run to run."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", c.cast("string"), F.lit(str(seed))))


def take_exact(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows of ``df``, without ordering them and without a shuffle of the rows.

    Meant for rows that are interchangeable, such as copies of one customer.
    """
    # Positions are written with the rows: a later job may split the table in another way.
    place = materialise(df.withColumn("_place", F.monotonically_increasing_id()))
    part, offset = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = place.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size")).collect()
    quota, left = [], n
    for row in sorted(sizes):
        quota.append((row["_part"], min(row["_size"], left)))
        left -= quota[-1][1]
        if left == 0:
            break
    # One entry per input partition actually used, far below any row count.
    allowed = df.sparkSession.createDataFrame(quota, "_part bigint, _quota bigint")
    return (
        place.withColumn("_part", part)
        .join(F.broadcast(allowed), "_part")
        .where(offset < F.col("_quota"))
        .select(*df.columns)
    )


def _place(key: str, seed: int) -> Column:
    """Text that sorts rows by digest, then key. One expression, so that a filter on it
    computes the digest once per row."""
    return F.concat(seeded_digest(key, seed), F.lit("|"), F.coalesce(F.col(key).cast("string"), F.lit("")))


def _cells(keys: DataFrame, digits: int, by: Sequence[str] = ()) -> list:
    """Row counts per leading digits of the digest, at most 65,536 lines per group."""
    return keys.groupBy(*by, F.substring("_at", 1, digits).alias("cell")).agg(F.sum("_n").alias("n")).collect()


def _crossing(cells: list, wanted: int) -> tuple[str, int, int]:
    """(cell, rows in it, rows before it) of the cell that holds the ``wanted``-th row."""
    before = 0
    for row in sorted(cells, key=lambda r: r["cell"]):
        if before + row["n"] >= wanted:
            return row["cell"], row["n"], before
        before += row["n"]
    raise ValueError("fewer rows than wanted")


def _edge(rows: DataFrame, cells: list, wanted: int) -> tuple[str, int, int]:
    """(place, rows before it, copies of it) of the ``wanted``-th row."""
    cell, inside, below = _crossing(cells, wanted)
    # Copies are counted before anything else: about one key in 65,536 is left.
    keys = rows.where(F.col("_at").startswith(cell)).groupBy("_at").agg(F.sum("_n").alias("_n"))
    if inside > _RANK_LIMIT:
        keys, digits = materialise(keys), _CELL_DIGITS
        while digits < _DIGITS and keys.count() > _RANK_LIMIT:
            digits += _CELL_DIGITS
            cell, _, before = _crossing(_cells(keys, digits), wanted - below)
            keys, below = keys.where(F.col("_at").startswith(cell)), below + before
    ranked = keys.withColumn("upto", F.sum("_n").over(Window.orderBy("_at")))
    last = ranked.where(F.col("upto") >= wanted - below).orderBy("_at").first()
    return last["_at"], below + last["upto"] - last["_n"], last["_n"]


def lowest_by_hash_per_group(
    df: DataFrame, key: str, group: str, quotas: Callable[[dict], dict], seed: int = 42
) -> DataFrame:
    """From every group the rows with the smallest seeded hash of ``key``: a repeatable
    random sample of exact size. ``quotas`` turns the group sizes into wanted row counts.

    One pass counts hash cells of all groups, a second looks into the cell at each cut-off,
    and the result is a single filter: no task ever sorts the table. Copies of a key that
    only partly fit are interchangeable and taken with :func:`take_exact`.
    """
    at = _place(key, seed)
    keyed = df.where(F.col(group).isNotNull()).select(F.col(group).alias("_g"), at.alias("_at"), F.lit(1).alias("_n"))
    cells: dict = {}
    for row in _cells(keyed, _CELL_DIGITS, ["_g"]):
        cells.setdefault(row["_g"], []).append(row)
    sizes = {g: sum(row["n"] for row in rows) for g, rows in cells.items()}
    keep, partial = F.lit(False), []
    for g, wanted in sorted(quotas(sizes).items()):
        here = F.col(group) == g
        if wanted >= sizes[g]:
            keep = keep | here
        elif wanted > 0:
            edge, before, copies = _edge(keyed.where(F.col("_g") == g), cells[g], wanted)
            if before + copies == wanted:
                keep = keep | (here & (at <= edge))
            else:
                keep = keep | (here & (at < edge))
                partial.append((here & (at == edge), wanted - before))
    out = df.where(keep)
    for copies_of_edge, n in partial:
        out = out.unionByName(take_exact(df.where(copies_of_edge), n))
    return out


def lowest_by_hash(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash of ``key``."""
    whole = df.withColumn("_all", F.lit(1))
    return lowest_by_hash_per_group(whole, key, "_all", lambda sizes: {g: n for g in sizes}, seed).drop("_all")
