"""N-gram Jaccard join: components of documents whose shingle sets overlap enough.

The result is components, not links: pairs that already lie in one component are not compared.

1. One pass gives each document its set size, a class for equal sets, a bitmap signature with one
   bit of parity per hash cell, six minhash keys, and the corpus a table of shingle counts of
   fixed size.
2. Classes are tied to the class with the most copies, and to the smallest, among those that
   share a minhash key; ties that hold exactly join most near copies into components early on.
3. For completeness, each class is filed under the rarest of its shingles, enough of them that
   two linked classes share one. A shingle's classes in order of size form a tile, in which a
   class meets only those within the size band, and where enough members follow in both. Pairs
   that already lie in one component are left out: they cannot change the result.
4. Pairs are checked by their signatures first: the bits that differ bound the overlap from
   above. What is left is intersected exactly, as sorted arrays.

Set members are 64-bit hashes of the shingles, and classes 64-bit hashes of the sets. Every row has
a written key, and a class fetches its text by the key of one of its rows: doc_id may be null, or
stand for several texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import sums
from ebbtide.llm.common import hashed, keyed, materialise, mix, narrow, table, texts_of, windows
from ebbtide.llm.graph import components

WORDS, PERCENT = 5, 75
COUNT_BITS = 19
BANDS, BAND_ROWS = 6, 2
#: Filed shingles that one task compares; the number of tasks follows from the corpus.
TASK_ENTRIES = 400_000
_SEEDS = np.random.default_rng(5).integers(1, 1 << 62, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; all words as one shingle where there are fewer."""
    for _, value, offsets in hashed(texts):
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            yield np.unique(windows(value[a:b], min(words, b - a))) if b > a else np.zeros(0, np.uint64)


def class_of(members: np.ndarray) -> int:
    total = mix(members + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(members))]))[0].astype(np.int64))


def signature(members: np.ndarray) -> bytes:
    """Parity of the members in each of b cells, b a power of two of at least 64 and their number."""
    bits = 1 << max(6, int(len(members) - 1).bit_length())
    odd = np.bincount((members & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Cells of odd difference: no more than members that only one side has."""
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def minhash_keys(members: np.ndarray) -> list[int]:
    least = np.array([(members * s).min() for s in _SEEDS], np.uint64).reshape(BANDS, BAND_ROWS)
    return mix(windows_of_rows(least) + np.arange(BANDS, dtype=np.uint64)).astype(np.int64).tolist()


def windows_of_rows(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + column)
    return out


def enough(shared: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (a + b - shared)


_SHEET = "row long, doc_id long, n long, class long, keys array<long>, bits binary, slice int, cells binary"


def _first():
    """The first row: by doc_id, nulls last, then by key."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))


def _describe(words: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        names = ["row", "doc_id", "n", "class", "keys", "bits", "slice", "cells"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]
        for b in batches:
            rows: list[tuple] = []
            for members in shingles(texts_of(b.column(2)), words):
                np.add.at(counts, (members >> np.uint64(64 - COUNT_BITS)).astype(np.int64), 1)
                rows.append((len(members), class_of(members), minhash_keys(members), signature(members)) if len(members) else (0, None, None, None))
            n = len(rows)
            own = [b.column(0), b.column(1), *[pa.array([r[k] for r in rows], types[k + 2]) for k in range(4)], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(own, names=names)
        part = sums.rows_of(counts)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(part.num_rows, t) for t in types[:6]], *part.columns], names=names)

    return describe


def _possible(percent: int):
    """Pairs whose sizes and signatures allow a link."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = (b.column(x).to_numpy() for x in ("na", "nb"))
            keep = []
            for x, y, p, q in zip(na.tolist(), nb.tolist(), b.column("bits_a").to_pylist(), b.column("bits_b").to_pylist(), strict=True):
                keep.append(100 * min(x, y) >= percent * max(x, y) and enough((x + y - differing_bits(p, q)) // 2, x, y, percent))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return sift


def _exact(words: int, percent: int):
    """Pairs whose sets, as sorted arrays, overlap enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}
        for b in batches:
            left = shingles(texts_of(b.column("text_a")), words)
            keep = []
            for mine, other, text in zip(left, b.column("b").to_pylist(), b.column("text_b").cast(pa.binary()), strict=True):
                if other not in recent:
                    if len(recent) > 16:
                        recent.clear()
                    recent[other] = next(shingles([text.as_py() or b""], words))
                theirs = recent[other]
                at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
                keep.append(enough(int((theirs[at] == mine).sum()), len(mine), len(theirs), percent))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return check


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) that link."""
    sheet = classes.select("class", "n", "bits")
    one, two = (sheet.toDF(x, f"n{x}", f"bits_{x}") for x in "ab")
    near = materialise(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "bits_a", "bits_b").mapInArrow(_possible(percent), "a long, b long"))
    wanted = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = materialise(wanted.join(classes.select("class", "row"), "class"))
    # One text for each class. Written, so that both joins read shuffled tables, whose hot keys
    # (a leader of many classes) Spark splits.
    texts = materialise(narrow(docs, wanted, "row").select("class", "text"))
    both = near.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return materialise(both.select("a", "b", "text_a", "text_b").mapInArrow(_exact(words, percent), "a long, b long"))


def _file(counts: np.ndarray, buckets: int, words: int, percent: int):
    """File each class under its rarest shingles: rows of arrays, one for each bucket and batch."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[tuple[np.ndarray, int, int, int]] = []
            for members, own, group in zip(shingles(texts_of(b.column("text")), words), b.column("class").to_pylist(), b.column("component").to_pylist(), strict=True):
                n = len(members)
                load = counts[(members >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
                # A partner shares at least percent of n members, so one of these.
                some = n - -(-percent * n // 100) + 1
                held.append((members[np.lexsort((members, load))[:some]], n, own, group))
            if not held:
                continue
            size = np.array([len(x[0]) for x in held])
            token = np.concatenate([x[0] for x in held])
            bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = [np.repeat(np.array([x[k] for x in held], np.int64), size)[order] for k in (1, 2, 3)]
            token, place = token[order], np.concatenate([np.arange(k, dtype=np.int32) for k in size])[order]
            some = [k for k in range(buckets) if cut[k] < cut[k + 1]]
            arrays = [pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in some], pa.binary()) for x in (token, place, full[0].astype(np.int32), full[1], full[2])]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *arrays], names=["bucket", "tokens", "places", "sizes", "classes", "components"])

    return file


def _tiles(percent: int):
    """Pairs that meet in a tile of one bucket: same shingle, sizes within the band, not yet joined."""

    def meet(group: pa.Table) -> pa.Table:
        token, place, size, own, comp = (
            np.concatenate([np.frombuffer(x, t) for x in group.column(c).to_pylist()])
            for c, t in (("tokens", np.uint64), ("places", np.int32), ("sizes", np.int32), ("classes", np.int64), ("components", np.int64))
        )
        order = np.lexsort((own, size, token))
        token, size, own, comp = token[order], size[order].astype(np.int64), own[order], comp[order]
        # In the first tile where two classes meet, all they share lies from their places there on.
        after = size - place[order]

        def can(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return (comp[i] != comp[j]) & ((100 + percent) * np.minimum(after[i], after[j]) >= percent * (size[i] + size[j]))

        first = np.concatenate(([True], token[1:] != token[:-1]))
        run = np.cumsum(first) - 1
        begin = np.flatnonzero(first)
        # Only tiles whose members are not all in one component can add a pair.
        mixed = np.maximum.reduceat(comp, begin) != np.minimum.reduceat(comp, begin)
        left, right, held = [], [], 0
        length = np.diff(np.append(begin, len(token)))
        small = mixed[run] & (length[run] <= 64)
        i = np.flatnonzero(small)
        step = 1
        while len(i):
            i = i[i + step < len(token)]
            i = i[run[i + step] == run[i]]
            i = i[100 * size[i] >= percent * size[i + step]]
            apart = i[can(i, i + step)]
            left.append(own[apart])
            right.append(own[apart + step])
            step += 1
        for r in np.flatnonzero(mixed & (length > 64)):
            rows = np.arange(begin[r], begin[r] + length[r])
            values, many = np.unique(comp[rows], return_counts=True)
            main = values[np.argmax(many)]
            # Everything that is not in the largest component meets everything that is.
            for s in rows[comp[rows] != main]:
                band = rows[(100 * np.minimum(size[rows], size[s]) >= percent * np.maximum(size[rows], size[s])) & can(rows, np.full(len(rows), s))]
                band = band[(band > s) | (comp[band] == main)]
                left.append(np.full(len(band), own[s]))
                right.append(own[band])
                held += len(band)
                if held > 1_000_000:  # the same pairs meet in many tiles
                    left, right, held = *([x] for x in _distinct(left, right)), 0
        a, b = _distinct(left, right)
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return meet


def _distinct(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, class, component_id.

    Words are what stands between white space, A-Z in lower case; a document with fewer than
    ``words`` words has them all as one shingle. Documents link when their sets overlap by
    ``percent`` of their union. ``component_id`` is the smallest doc_id that links reach, the
    document's own without links. Null and empty texts have no shingles and link with nothing.
    Only components are found, not every link inside them.
    Repeated rows each give a row; a row with a null doc_id takes part, but never names a
    component. Other columns are ignored.
    """
    rows, found = _grouped(keyed(docs.select("doc_id", "text")), words, percent)
    least = found.groupBy("root_").agg(F.min("doc_id").alias("component_id"))
    labels = materialise(found.select("class", "root_").join(least, "root_").select("class", "component_id"))
    out = narrow(rows.select("doc_id", "n", "class"), labels, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "class")


def _grouped(numbered: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """For ``keyed`` documents: their rows (row, doc_id, n, class), and the classes (class, doc_id,
    row, root_), each with its first row by doc_id, nulls last, then key, and its component."""
    docs = numbered.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    sheet = materialise(docs.mapInArrow(_describe(words), _SHEET))
    rows = sheet.where("slice IS NULL")
    counts = sums.total(sheet.where("slice IS NOT NULL").select("slice", "cells"), 1 << COUNT_BITS).astype(np.int32)
    classes = rows.where("class IS NOT NULL").groupBy("class").agg(
        _first().alias("least"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("keys").alias("keys"),
        F.count(F.lit(1)).alias("copies"),
    )
    classes = materialise(classes.select("class", "least.doc_id", "least.row", "n", "bits", "keys", "copies"))

    hashes = classes.select("class", "copies", F.explode("keys").alias("key"))
    most = F.max(F.struct("copies", "class"))["class"]
    leaders = hashes.groupBy("key").agg(F.array_distinct(F.array(most, F.min("class"))).alias("leaders"), F.count(F.lit(1)).alias("many")).where("many > 1")
    ties = hashes.join(leaders, "key").select(F.col("class").alias("a"), F.explode("leaders").alias("b")).where("a != b").distinct()
    early = verified(materialise(ties), classes, docs, words, percent)
    joined = components(early).withColumnRenamed("id", "class")

    named = classes.select("class", "row").join(joined, "class", "left")
    named = materialise(named.select("row", "class", F.coalesce("component_id", "class").alias("component")))
    members = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(8, -(-members * (100 - percent) // (100 * TASK_ENTRIES)))
    entries = narrow(docs, named, "row").select("text", "class", "component")
    filed = entries.mapInArrow(_file(counts, buckets, words, percent), "bucket int, tokens binary, places binary, sizes binary, classes binary, components binary")
    pairs = materialise(filed.groupBy("bucket").applyInArrow(_tiles(percent), "a long, b long").distinct())
    late = verified(pairs, classes, docs, words, percent)

    reached = components(early.union(late)).withColumnRenamed("id", "class")
    found = classes.select("class", "doc_id", "row").join(reached, "class", "left")
    return rows, materialise(found.select("class", "doc_id", "row", F.coalesce("component_id", "class").alias("root_")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with its columns: the smallest doc_id, nulls last.

    Rows are told apart by a key written with them, so a doc_id may be null or stand for several
    texts. A row without shingles (null or empty text) is a component of its own and is kept.
    """
    numbered = keyed(docs)
    rows, found = _grouped(numbered)
    kept = found.groupBy("root_").agg(_first().alias("least")).select("least.row")
    kept = materialise(kept.union(rows.where("class IS NULL").select("row")))
    return narrow(numbered, kept, "row").select("doc.*")


def op6_ngram_jaccard_join(spark, folder: str) -> DataFrame:
    """All documents, grouped at a similarity of 0.75 of their 5-word shingles."""
    return jaccard_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
