"""Near-duplicate vectors: subspace pigeonhole join.

Unit vectors with cosine >= c are at a squared distance of at most 2 - 2c. After a rotation the
coordinates are split into bands of four blocks; the squared distance is the sum over the bands,
so in at least one band it is within that band's share of the budget. Every band is a range join
of its own: one coordinate is cut into cells twice as wide as the band's radius, and a vector is
compared in its own cell and, if it lies within the radius of its lower end, in the one below. A
pair belongs to the first band whose share it keeps, is checked exactly there with the given
vectors, and is counted there once.

A vector is sent as given, at most twice per band and part of a crowded cell; parts are large,
since what is sent grows with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import drop_finished, materialise, narrow, table
from ebbtide.llm.graph import components

BLOCK_DIMS, BAND_BLOCKS = 8, 4
BAND_DIMS = BLOCK_DIMS * BAND_BLOCKS
#: Vectors of one cell that are compared in one task; larger cells are cut, and every pair of parts is compared.
CELL_ROWS = 40_000
_SLACK = 1e-6
#: What products of unit vectors in single precision may be off, and more.
_SINGLE = 1e-4


def _rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(7).standard_normal((dims, dims)))[0]


def _unit(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))
    # Divided by the largest component first: squares of very large or small ones leave the range of doubles.
    largest = np.abs(rows).max(axis=1, keepdims=True) if rows.size else np.ones((len(rows), 1))
    rows = rows / np.where(largest > 0, largest, 1)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _share(least: float, dims: int, size: int) -> float:
    """Squared distance up to which a band of ``size`` coordinates keeps a pair, rounding included."""
    return (2 - 2 * least) * size / dims + _SLACK


def _turned(unit: np.ndarray) -> np.ndarray:
    """Rotated vectors; each row's bits are the same whatever rows stand beside it."""
    return np.einsum("ij,jk->ik", unit, _rotation(unit.shape[1]), optimize=False)


def _cells(least: float, sent: tuple[str, ...]):
    """Home cell of every vector in every band, and the cell below where a pair may reach into it, with the columns ``sent``."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            by_dims = pc.list_value_length(b.column("vector")).to_numpy()
            for dims in np.unique(by_dims):
                own = b.take(pa.array(np.flatnonzero(by_dims == dims)))
                turned = _turned(_unit(own.column("vector")))
                for band, at in enumerate(range(0, dims, BAND_DIMS)):
                    # Wider than the root of the share, so a pair within it lies at most one cell apart.
                    radius = np.sqrt(_share(least, dims, min(BAND_DIMS, dims - at))) * (1 + 1e-9)
                    cell = np.floor(turned[:, at] / (2 * radius)).astype(np.int32)
                    low = turned[:, at] - cell * (2 * radius) <= radius * (1 + 1e-9)
                    for home in (True, False):
                        there = own if home else own.filter(pa.array(low))
                        n = there.num_rows
                        keys = [pa.array(np.full(n, x, np.int32)) for x in (dims, band)]
                        yield pa.RecordBatch.from_arrays(
                            [*map(there.column, sent), *keys, pa.array(cell if home else cell[low] - 1), pa.array(np.full(n, home))],
                            names=[*sent, "dims", "band", "cell", "home"],
                        )

    return put


def _compare(least: float):
    """Links inside one part of a cell, or between two: links per vector, and edges that join what hangs together."""

    def links(group: pa.Table) -> pa.Table:
        ids, copies = group.column("class").to_numpy(), group.column("copies").to_numpy()
        home, part = group.column("home").to_numpy(), group.column("part").to_numpy()
        band, (first, second) = group.column("band")[0].as_py(), (group.column(x)[0].as_py() for x in ("part_a", "part_b"))
        exact = _unit(group.column("vector"))
        dims = exact.shape[1]
        turned = _turned(exact)
        degree, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        left, right = np.flatnonzero(part == first), np.flatnonzero(part == second)

        def within(i: np.ndarray, j: np.ndarray, b: int) -> np.ndarray:
            at = b * BAND_DIMS
            size = min(BAND_DIMS, dims - at)
            gap = turned[i, at : at + size] - turned[j, at : at + size]
            return np.einsum("ij,ij->i", gap, gap) <= _share(least, dims, size)

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        at, size = band * BAND_DIMS, min(BAND_DIMS, dims - band * BAND_DIMS)
        sub = turned[:, at : at + size].astype(np.float32)
        # |a - b|^2 <= share as a product that is large enough; what is close to it is checked in double precision.
        half = np.einsum("ij,ij->i", sub, sub) / 2
        least_product = np.float32(_share(least, dims, size) / 2 + _SINGLE)
        others, right_half = np.ascontiguousarray(sub[right].T), half[right] - least_product
        for start in range(0, len(left), 512):
            rows = left[start : start + 512]
            i, j = np.nonzero(sub[rows] @ others >= half[rows, None] + right_half)
            i, j = rows[i], right[j]
            keep = (home[i] | home[j]) & ((i < j) if first == second else True)
            i, j = i[keep], j[keep]
            for b in range(band):
                if len(i):
                    later = ~within(i, j, b)
                    i, j = i[later], j[later]
            if not len(i):
                continue
            linked = within(i, j, band) & (np.einsum("ij,ij->i", exact[i], exact[j]) >= least)
            i, j = i[linked], j[linked]
            np.add.at(degree, i, copies[j])
            np.add.at(degree, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if (p := root(x)) != (q := root(y)):
                    parent[max(p, q)] = min(p, q)
        some = np.flatnonzero(degree)
        return pa.table({
            "class": pa.array(ids[some]), "links": pa.array(degree[some]),
            "other": pa.array(np.array([ids[root(x)] for x in some.tolist()], np.int64)),
        })

    return links


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """One row per vector of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Two vectors link when their labels are equal and their cosine, in double precision, is at
    least ``least`` (above 0). Vectors that are null, zero, or hold null or non-finite components,
    and vectors without a label or of another dimension, link with nothing. Equal vectors of a label are
    compared as one; a row that repeats in all three columns counts once. A null vec_id gives a row without links
    whose component is null. Other columns are ignored.
    """
    e = F.col("embedding")
    given = e if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else e.cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), given.alias("vector"), F.col("label"))
    wide = F.col("vector").cast("array<double>")
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(wide, lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))
    rows = rows.withColumn("h1", F.when(usable, F.xxhash64(wide))).withColumn("h2", F.when(usable, F.xxhash64(F.lit(1), wide, "label")))
    # Of the vectors that may link, only hashes go on; one of each class is fetched once.
    key = ["label", "h1", "h2"]
    first = rows.where("h1 IS NOT NULL").groupBy(*key).agg(F.first("vector").alias("vector"))
    rows = materialise(rows.select("vec_id", *key, F.when(F.col("h1").isNull(), F.col("vector")).alias("odd")).distinct().drop("odd"))
    classes = rows.where("h1 IS NOT NULL").groupBy(*key).agg(F.min("vec_id").alias("class"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(first.join(classes, key))
    label, kind = (classes.schema[c].dataType.simpleString() for c in ("label", "vector"))

    def cells(*sent: str) -> DataFrame:
        kinds = {"class": "long", "label": label, "copies": "long", "vector": kind}
        ddl = ", ".join(f"{c} {kinds[c]}" for c in sent) + ", dims int, band int, cell int, home boolean"
        return classes.select(*dict.fromkeys([*sent, "vector"])).mapInArrow(_cells(least, sent), ddl)

    key = ["label", "dims", "band", "cell"]
    crowded = materialise(cells("label").groupBy(*key).agg(F.count(F.lit(1)).alias("n_")).where(F.col("n_") > CELL_ROWS))
    drop_finished(vectors.sparkSession)
    parts = F.coalesce(F.ceil(F.col("n_") / CELL_ROWS), F.lit(1)).cast("int")
    cut = narrow(cells("class", "label", "copies", "vector"), crowded, key, "left").withColumn("parts_", parts).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts_")).cast("int"))
    cut = cut.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1)))
    pairs = cut.withColumn("part_a", F.least("part", "other_")).withColumn("part_b", F.greatest("part", "other_")).drop("n_", "parts_", "other_")
    # Dealt by the parts too: a partitioning by the cell alone would satisfy the grouping, with all parts of a cell in one task.
    pairs = pairs.repartition(*key, "part_a", "part_b")
    found = materialise(pairs.groupBy(*key, "part_a", "part_b").applyInArrow(_compare(least), "class long, links long, other long"))

    per_class = found.groupBy("class").agg(F.sum("links").alias("links"))
    reached = components(found.select("class", "other")).withColumnRenamed("id", "class")
    sheet = classes.select("label", "h1", "h2", "class", "copies").join(per_class, "class", "left").join(reached, "class", "left")
    sheet = sheet.select(
        "label", "h1", "h2",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "class").alias("component_id"),
    )
    out = rows.select("vec_id", "label", "h1", "h2").join(sheet, ["label", "h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op2_subspace_near_vectors(spark, folder: str) -> DataFrame:
    """All vectors of ``embeddings``: links at a cosine of 0.93 or more within a label."""
    return near_vectors(table(spark, folder, "embeddings"), least=0.93)
