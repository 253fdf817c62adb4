"""Best-fit packing of documents into sequences of a fixed number of tokens.

The packing depends on the lengths of the pieces alone, of which there are at most as many as
the capacity. Lengths are therefore counted with Spark, the counts are packed, and the pieces
look up their places with Spark. What the driver handles is bounded by the capacity, whatever
the number of documents.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import batch, materialise, table, texts_of
from ebbtide.llm.vocab import WordEnds, default_path, encoder

END_ID = 1

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("part_", pa.int32()), ("nth_", pa.int64()), ("ids", pa.binary()),
])


def token_pieces(docs: DataFrame, capacity: int, path: str, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, one row each; ``nth_`` counts equal lengths within a task.

    Only documents that are longer than the capacity are cut. A null text counts as empty and
    still gives the end id. ``ids`` holds the token ids as little-endian 32-bit integers if
    ``keep_ids``, else null.
    """
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(WordEnds, path)
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = defaultdict(list)
            for doc_id, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                ids = words.encode(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    length = len(piece) // 4
                    values = (doc_id, n, at // 4, length, zlib.crc32(piece), part, seen[length], piece if keep_ids else None)
                    for name, value in zip(_PIECES.names, values, strict=True):
                        rows[name].append(value)
                    seen[length] += 1
            if rows:
                yield batch(rows, _PIECES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part_ int, nth_ long, ids binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Places for ``counts[length]`` pieces of each length, and the number of bins.

    A place is (length, first, bins, each, bin, offset): the pieces of that length with ranks
    from ``first`` on fill ``bins`` bins from number ``bin`` on, ``each`` per bin, from
    ``offset`` on. Lengths above a third of the capacity are matched first, longest first, each
    with the longest other that still fits; no bin can hold three of them. Then the others, longest
    first, go to the smallest gap that holds them, as many as fit.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    places: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, number of bins)
    order: list[int] = []  # the gaps that have bins, ascending
    bins = 0

    def put(length: int, many: int, each: int, at: int, offset: int) -> None:
        places.append((length, used[length], many, each, at, offset))
        used[length] += many * each
        left[length] -= many * each

    def free(gap: int, at: int, many: int) -> None:
        if gap and many:
            if not gaps[gap]:
                bisect.insort(order, gap)
            gaps[gap].append((at, many))

    large = sorted(n for n in left if 3 * n > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and (not left[large[at]] or (large[at] == length and left[length] < 2)):
                at -= 1
            if at < 0:
                many = left[length]
                put(length, many, 1, bins, 0)
                free(capacity - length, bins, many)
            else:
                other = large[at]
                many = left[length] // 2 if other == length else min(left[length], left[other])
                put(length, many, 1, bins, 0)
                put(other, many, 1, bins, length)
                free(capacity - length - other, bins, many)
            bins += many

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(order, length)
            if at == len(order):  # no gap holds it: new bins, filled as far as they go
                each = min(capacity // length, left[length])
                many = left[length] // each
                first, gap = bins, capacity
                bins += many
            else:
                gap = order[at]
                first, there = gaps[gap].pop()
                each = min(gap // length, left[length])
                many = min(there, left[length] // each)
                if many < there:
                    gaps[gap].append((first + many, there - many))
                elif not gaps[gap]:
                    order.pop(at)
            put(length, many, each, first, capacity - gap)
            free(gap - each * length, first, many)
    return places, bins


def _look_up(places: list[tuple[int, int, int, int, int, int]], length: int, rank: int):
    """Bin and offset of each piece from its length and its rank among equal lengths."""
    sheet = np.array(sorted(places), dtype=np.int64).reshape(-1, 6)
    bounds = np.searchsorted(sheet[:, 0], np.arange(sheet[-1, 0] + 2 if len(sheet) else 1))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths, ranks = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (length, rank))
            row = np.zeros(len(lengths), np.int64)
            for n in np.unique(lengths):
                own = lengths == n
                lo, hi = bounds[n], bounds[n + 1]
                row[own] = lo + np.searchsorted(sheet[lo:hi, 1], ranks[own], side="right") - 1
            _, first, _, each, at, offset = sheet[row].T
            back = ranks - first
            places = [pa.array(at + back // each), pa.array(offset + back % each * lengths)]
            yield pa.RecordBatch.from_arrays([*b.columns, *places], names=[*b.schema.names, "sequence_id", "offset"])

    return look


def packed(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with ``length``, ``part_``, ``nth_``) with ``sequence_id`` and ``offset``.

    ``pieces`` must be a written table, since its ranks within tasks are counted again.
    """
    per_part = pieces.groupBy("length", "part_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy("length").orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_part.select("length", "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("ahead_"))
    # At most one row for each length up to the capacity.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, _ = plan_bins(counts, capacity)
    ranked = pieces.join(ahead, ["length", "part_"]).withColumn("rank_", F.col("ahead_") + F.col("nth_")).drop("ahead_", "nth_", "part_")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in ranked.schema.fields)}, sequence_id long, offset long"
    look = _look_up(places, ranked.columns.index("length"), ranked.columns.index("rank_"))
    return ranked.mapInArrow(look, schema).drop("rank_")


def pack_documents(docs: DataFrame, capacity: int = 4096, path: str | None = None, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pack tokenised ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if
    ``keep_ids``. Repeated rows are packed each on its own; other columns are ignored; a null
    text is empty; an empty table gives an empty table.
    """
    pieces = materialise(token_pieces(docs, capacity, path or default_path("word_bpe_49k.json"), end_id, keep_ids))
    out = packed(pieces, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)


def op10_best_fit_packing(spark, folder: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens."""
    return pack_documents(table(spark, folder, "documents"))
