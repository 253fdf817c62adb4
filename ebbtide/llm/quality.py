"""Quality of documents: random-indexing word vectors, pooled, and a small calibrated network.

Words are runs of letters, digits or marks, hashed to a fixed number of rows. Each row has a
sparse random index vector; its word vector is that plus the sum of the index vectors of all its
direct neighbours in the whole corpus. A document is the mean over its words, together with the
shares of capital, repeated, mark and digit words, and its length. The network is trained on a
bounded sample of labelled documents; every count behind the vectors covers all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.llm import sums
from ebbtide.llm.common import chunks, materialise, runs, table, texts_of

ROWS, DIMS, NONZERO = 1 << 14, 32, 4
SHAPES = 4
#: Labelled documents that the network sees, the first in the order of a hash.
SAMPLE = 20_000
ACCEPT = 0.7

#: Byte classes: letters (all of UTF-8 beyond ASCII), digits, marks; 0 separates.
_CLASSES = np.full(256, 3, np.uint8)
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 0
_CLASSES[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = 1
_CLASSES[ord("0") : ord("9") + 1] = 2
_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[ord("A") : ord("Z") + 1] = 1

_rng = np.random.default_rng(11)
_PLACES = np.argsort(_rng.random((ROWS, DIMS)), axis=1)[:, :NONZERO]
_SIGNS = _rng.choice([-1, 1], (ROWS, NONZERO))


def _words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: first document, table rows of its words, shape flags, and word offsets of documents."""
    for start, end in chunks(texts):
        part = texts[start:end]
        buffer = np.frombuffer(b"\n".join(part), np.uint8)
        begin, stop, value = runs(buffer, _CLASSES)
        capital = np.concatenate(([0], np.cumsum(_CAPITAL[buffer])))
        kind = _CLASSES[buffer[begin]] if len(begin) else np.zeros(0, np.uint8)
        size = stop - begin
        offsets = np.searchsorted(begin, np.cumsum([0, *(len(t) + 1 for t in part)]))
        again = np.zeros(len(begin), bool)
        again[1:] = value[1:] == value[:-1]
        again[offsets[:-1][offsets[:-1] < len(begin)]] = False
        shapes = np.stack([(size > 1) & (capital[stop] - capital[begin] == size), again, kind == 3, kind == 2], axis=1)
        yield start, (value >> np.uint64(50)).astype(np.int64), shapes, offsets


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the index vectors of direct neighbours, over the documents of a task."""
    cells = np.zeros(ROWS * DIMS)
    for b in batches:
        for _, rows, _, offsets in _words(texts_of(b.column(0))):
            inside = np.ones(max(len(rows) - 1, 0), bool)
            last = offsets[1:-1] - 1
            inside[last[(last >= 0) & (last < len(inside))]] = False
            left, right = rows[:-1][inside], rows[1:][inside]
            for a, c in ((left, right), (right, left)):
                cells += np.bincount((a[:, None] * DIMS + _PLACES[c]).ravel(), _SIGNS[c].ravel().astype(float), ROWS * DIMS)
    yield sums.rows_of(np.rint(cells))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors from all ``docs`` (text): a table of fixed size."""
    cells = sums.total(docs.select(F.col("text").cast("string")).mapInArrow(_contexts, sums.DDL), ROWS * DIMS).reshape(ROWS, DIMS).astype(float)
    index = np.zeros((ROWS, DIMS))
    np.put_along_axis(index, _PLACES, _SIGNS.astype(float), axis=1)
    context = cells / np.maximum(np.linalg.norm(cells, axis=1, keepdims=True), 1)
    return (index / np.sqrt(NONZERO) + context).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One row of features per text; an empty text is all zero."""
    out = np.zeros((len(texts), DIMS + SHAPES + 2), np.float32)
    for start, rows, shapes, offsets in _words(texts):
        size = np.diff(offsets)
        some = np.flatnonzero(size)
        if not len(some):
            continue
        at = offsets[:-1][some]
        n = size[some][:, None]
        out[start + some, :DIMS] = np.add.reduceat(vectors[rows], at, axis=0) / n
        out[start + some, DIMS : DIMS + SHAPES] = np.add.reduceat(shapes.astype(np.float32), at, axis=0) / n
        out[start + some, -1] = np.log1p(n[:, 0])
    out[:, -2] = np.linalg.norm(out[:, :DIMS], axis=1)
    return out


@dataclass
class Network:
    """Two layers over standardised features; the temperature divides the last logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, steps: int = 400, decay: float = 1e-3) -> Network:
    """Train on four fifths, then set the temperature on the rest.

    Without both labels, the score is the constant (ones + 1) / (rows + 2).
    """
    width = x.shape[1]
    if len(y) < 20 or len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)
    rng = np.random.default_rng(3)
    order = rng.permutation(len(y))
    rest, own = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[own].mean(0), x[own].std(0) + 1e-3
    z, t = (x[own] - mean) / scale, y[own].astype(float)
    p = [rng.standard_normal((width, hidden)) / np.sqrt(width), np.zeros(hidden), rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    for step in range(1, steps + 1):
        h = np.tanh(z @ p[0] + p[1])
        gap = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - t) / len(t)
        back = np.outer(gap, p[2]) * (1 - h * h)
        for k, g in enumerate((z.T @ back + decay * p[0], back.sum(0), h.T @ gap + decay * p[2], np.array([gap.sum()]))):
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            p[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    logits, truth = net.logits(x[rest]), y[rest].astype(float)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
    loss = [np.mean(np.logaddexp(0, logits / g) - truth * logits / g) for g in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int = SAMPLE) -> Network:
    """Network on at most ``sample`` labelled documents outside the held-out fold.

    Labels other than 0 and 1, and documents whose labels differ, are not used.
    """
    usable = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(fold(F.col("doc_id"), 4) != 2)
    agreed = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most_")).where("quality = most_")
    chosen = agreed.select("doc_id", F.col("quality").cast("int").alias("label_")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = materialise(chosen)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(texts_of(b.column(1)), vectors)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "label_", "x"])

    # At most ``sample`` rows: a proven bound.
    there = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label_")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = there.mapInArrow(features, f"doc_id {kind}, label_ int, x array<float>").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(sample).collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), DIMS + SHAPES + 2)
    return fit_network(x, np.array([r["label_"] for r in rows], np.int64))


def scored(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """Every row of ``docs`` as ``doc``, whatever its columns are called, and ``score`` (double, 0 to
    1), in one pass and without a shuffle."""
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = network.score(pooled(texts_of(b.column(0).flatten()[at]), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc", "score"])

    whole = docs.select(F.struct("*").alias("doc"))
    return whole.mapInArrow(score, T.StructType([whole.schema["doc"], T.StructField("score", T.DoubleType())]))


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Null and empty texts get the score of a document without words; repeated rows each give a
    row; a null doc_id is not held out; other columns are ignored. Without labels every score is
    one half.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    vectors = word_vectors(slim)
    out = scored(slim, vectors, fit(slim, labels, vectors)).select("doc.doc_id", "score")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``ACCEPT``, with their columns.

    Each row is judged by its own text: a doc_id may be null or stand for several texts. Null and
    empty texts have the score of a document without words. Without labels no row is kept.
    """
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    vectors = word_vectors(slim)
    return scored(docs, vectors, fit(slim, labels, vectors)).where(F.col("score") >= ACCEPT).select("doc.*")


def op5_random_indexing_quality(spark, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    return classify_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
