"""Sums of long arrays over all tasks, without bringing the tasks' arrays together in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows that an array is cut into; each is summed on its own.
SLICES = 64

DDL = "slice int, cells binary"


def rows_of(cells: np.ndarray) -> pa.RecordBatch:
    """One task's array of 64-bit sums as rows (the last columns of its output)."""
    parts = np.array_split(cells.astype("<i8"), SLICES)
    small = [p.astype("<i4") if len(p) == 0 or np.abs(p).max() < 2**31 else p for p in parts]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([p.tobytes() for p in small], pa.binary())], names=["slice", "cells"])


def total(rows: DataFrame, length: int) -> np.ndarray:
    """The sum of the arrays behind ``rows``; ``length`` is fixed, so its size is too."""
    width = [len(p) for p in np.array_split(np.zeros(length, bool), SLICES)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k not in sums:
                    sums[k] = np.zeros(width[k], np.int64)
                sums[k] += np.frombuffer(cells, "<i4" if len(cells) == 4 * width[k] else "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["slice", "cells"])

    out = [np.zeros(w, np.int64) for w in width]
    for r in rows.repartition(SLICES, "slice").mapInArrow(add, DDL).collect():
        out[r["slice"]] = np.frombuffer(r["cells"], "<i8")
    return np.concatenate(out)
