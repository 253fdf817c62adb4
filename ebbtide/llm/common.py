"""Helpers shared by the corpus operators: texts out of Arrow, words, hashes, numbered tables."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import materialise  # noqa: F401  (the operators take it from here)

#: Bytes of text that are hashed at a time; a longer document makes a chunk of its own.
CHUNK = 1 << 20


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer rows per Arrow batch for what is written inside: whole texts make batches large, on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def keyed(df: DataFrame) -> DataFrame:
    """Every row of ``df`` as ``doc``, with a key of its own as ``row``; written, so the keys stay."""
    return materialise(df.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))


# --- hashes of all runs of a buffer, without a loop over words --------------------------

_rng = np.random.default_rng(20240229)
#: 64-bit values of the 256 bytes and an odd base for the polynomial.
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        row = np.full(max(n, CHUNK + 1024), base, dtype=np.uint64)
        row[0] = 1
        have = np.cumprod(row)
        # Very long documents get a table for the moment only.
        if n <= 4 * CHUNK:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Byte classes: 0 separates words. A-Z share the values of a-z.
WHITE = np.ones(256, dtype=np.uint8)
WHITE[[0x20, *range(0x09, 0x0E)]] = 0
_FOLDED = _VALUES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]


def runs(buffer: np.ndarray, classes: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the longest runs of bytes of one class other than 0.

    The hash of a run is a polynomial over its bytes, A-Z read as a-z, taken from differences
    of prefix sums modulo 2**64.
    """
    n = len(buffer)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    kind = classes[buffer]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    bounds = np.concatenate(([0], edge, [n]))
    keep = kind[bounds[:-1]] != 0
    starts, ends = bounds[:-1][keep], bounds[1:][keep]
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_FOLDED[buffer] * _powers_of(_BASE, "base", n), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers_of(_BASE_INVERSE, "inverse", n)[starts]
    return starts, ends, mix(value + (ends - starts).astype(np.uint64))


#: How to drop what a Python worker keeps from one task to the next (the word caches of tokenizers).
kept_by_worker: list[Callable[[], None]] = []


def release() -> None:
    """Drop it: workers outlive a stage, and the next one needs the memory for its own work."""
    while kept_by_worker:
        kept_by_worker.pop()()


def give_back() -> None:
    """Return free memory of this worker to the system: its allocators keep what a task had, and an executor has the sum of its workers."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def hashed(texts: list[bytes], classes: np.ndarray = WHITE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk of documents: number of the first, word hashes, and word offsets of each document."""
    release()
    for start, end in chunks(texts):
        part = texts[start:end]
        starts, _, value = runs(np.frombuffer(b"\n".join(part), dtype=np.uint8), classes)
        begin = np.cumsum([0, *(len(t) + 1 for t in part)])
        yield start, value, np.searchsorted(starts, begin)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(out)]
    return mix(out)


def word_hash(text: str) -> int:
    return int(runs(np.frombuffer(text.encode(), dtype=np.uint8))[2][0])


def batch(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


#: Rows of a key table that may be sent to every executor; a row is a few numbers.
BROADCAST_ROWS = 500_000


def narrow(big: DataFrame, keys: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with a written table of a few numbers per row.

    Counted first: up to ``BROADCAST_ROWS`` rows are sent to every executor, so ``big`` need not
    be shuffled; beyond that it is an ordinary join, whose skewed keys Spark splits.
    """
    return big.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, how)


def drop_finished(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now, not at the driver's next collection."""
    for _ in range(2):  # the first round frees what Python held, the second what that held in the JVM
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
