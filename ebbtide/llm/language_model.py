"""A smoothed bigram model over the whole corpus, scored as a weighted backoff automaton.

States are the words seen in training, and the root. A state has an arc for each word that
followed it, and a failure arc to the root, whose arcs carry the unigram probabilities:

    P(w | h) = (1 - l(h)) c(h w) / c(h) + l(h) P(w),    l(h) = K T(h) / (C(h) + K T(h))

P(w) takes a discount D = n1 / (n1 + 2 n2) from each known word and gives it to the one unknown
word. T(h) and C(h), successor types and count, are those of the history itself. A text is
traversed once, from the state of its beginning to its end token; the state is the word just
read, or the root after an unknown one.

The counts are never in one place. Documents are dealt into chunks; a chunk asks, per n-gram,
for the count over all chunks. Requests travel as arrays, one per chunk and hash range, and so
do the answers, which hold one number for each n-gram in the order in which it was asked for.
Of all chunks that ask for a pair seen in training one is named to speak for it: successor
types are summed per history over the pairs that chunks speak for, by a second such round. Hot
n-grams are one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import drop_finished, hashed, materialise, mix, table, texts_of

#: For callers that size a table of successor types by it; the model has one number per history.
CELLS = 1 << 12
#: Weight of the successor types against the count.
K = 4.0
CHUNK_BYTES = 8 << 20
RANGE_ENTRIES = 500_000
#: Tokens outside the range of word hashes in all likelihood: the end, and the state before the first word.
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts in a row, each text closed by the end token, and their number per text."""
    parts, sizes = [], []
    for _, value, offsets in hashed(texts):
        n = np.diff(offsets)
        parts.append(np.insert(value, offsets[1:], END))
        sizes.append(n + 1)
    return (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((parts, np.uint64), (sizes, np.int64)))


def _histories(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = START
    return before


def _pair(history: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hash of a pair."""
    return mix(history * np.uint64(0xD6E8FEB86659FD93) + token)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as planes of their bytes: the high planes are zeros and compress away."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pack(keys: np.ndarray) -> bytes:
    """Planes of the gaps between sorted keys."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpack(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data, "<u8"), dtype=np.uint64)


def _distinct(keys: np.ndarray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of every key among them, and how often each was trained on."""
    distinct, back = np.unique(keys, return_inverse=True)
    back = back.astype(np.int32)
    return distinct, back, np.bincount(back[trained], minlength=len(distinct))


_KEYS = pa.schema([("chunk", pa.int32()), ("order", pa.int32()), ("range", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_KEYS_DDL = "chunk int, order int, range int, keys binary, counts binary"


def _cut(chunk: int, order: int, distinct: np.ndarray, counts: np.ndarray, ranges: int) -> pa.Table:
    """Sorted distinct keys of a chunk with its own counts, one row per hash range."""
    counts = counts.astype("<i4")
    bucket = ((distinct >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    cut = np.searchsorted(bucket, np.arange(ranges + 1, dtype=np.uint64)).tolist()
    rows = [(chunk, order, k, _pack(distinct[a:b]), _planes(counts[a:b])) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _KEYS, strict=True)], schema=_KEYS) if rows else _KEYS.empty_table()


def _requests(ranges: int):
    """Distinct words (order 1) and pairs (order 2) of each chunk with their training counts, cut by hash range.

    Rows of a chunk come one after another; should a chunk be cut between two tasks, each asks
    for what it holds.
    """

    def ask(chunk: int, texts: list[bytes], aside: list[bool]) -> Iterator[pa.RecordBatch]:
        tokens, sizes = _tokens(texts)
        trained = np.repeat(~np.array(aside), sizes)
        for order in (1, 2):
            distinct, _, counts = _distinct(tokens if order == 1 else _pair(_histories(tokens, sizes), tokens), trained)
            yield from _cut(chunk, order, distinct, counts, ranges).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, texts, aside = None, [], []
        for b in batches:
            for c, text, out in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist(), strict=True):
                if c != chunk and texts:
                    yield from ask(chunk, texts, aside)
                    texts, aside = [], []
                chunk = c
                texts.append(text)
                aside.append(out)
        if texts:
            yield from ask(chunk, texts, aside)

    return run


_ANSWERS = "chunk int, order int, range int, counts binary, n long, v long, once long, twice long"


def _answers(group: pa.Table) -> pa.Table:
    """Totals of one hash range for every chunk in the order of its keys, and sums for the smoothing.

    Each number is twice the total, plus 1 in the one chunk that speaks for the key. All keys
    that were asked for are answered; a chunk that asked in two rows gets one for both.
    """
    order, part = group.column("order")[0].as_py(), group.column("range")[0].as_py()
    group = group.sort_by("chunk")
    keys = [_unpack(x) for x in group.column("keys").to_pylist()]
    own = np.concatenate([_numbers(x, "<i4") for x in group.column("counts").to_pylist()]).astype(np.int64)
    chunk = np.repeat(group.column("chunk").to_numpy(), [len(x) for x in keys])
    key = np.concatenate(keys)
    place = np.argsort(key, kind="stable")  # rows of sorted arrays: mostly merging
    key, own, chunk = key[place], own[place], chunk[place]
    entry = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1]))))
    key, own, chunk = key[entry], np.add.reduceat(own, entry), chunk[entry]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    each = np.add.reduceat(own, begin)
    told = np.repeat(2 * each, np.diff(np.append(begin, len(key))))
    told[begin] += each > 0
    told = told[np.argsort(chunk, kind="stable")].astype("<i8")
    names, sizes = np.unique(chunk, return_counts=True)
    ends = np.cumsum(sizes)
    many = len(names)
    first = [int(each.sum()), int((each > 0).sum()), int((each == 1).sum()), int((each == 2).sum())] if order == 1 else [0] * 4
    return pa.table({
        "chunk": pa.array(names, pa.int32()), "order": pa.array([order] * many, pa.int32()), "range": pa.array([part] * many, pa.int32()),
        "counts": pa.array([_planes(told[b - n : b]) for n, b in zip(sizes.tolist(), ends.tolist(), strict=True)], pa.binary()),
        **{x: pa.array([v, *[0] * (many - 1)], pa.int64()) for x, v in zip(("n", "v", "once", "twice"), first, strict=True)},
    })


def _told(answers: pa.Table, order: int) -> np.ndarray:
    """The numbers of all sorted distinct keys of a chunk: ranges follow each other as their keys do."""
    of = answers.filter(pa.compute.equal(answers.column("order"), order)).sort_by("range")
    return np.concatenate([np.zeros(0, "<i8"), *[_numbers(x, "<i8") for x in of.column("counts").to_pylist()]])


def _successors(ranges: int):
    """Per history of a chunk the pairs that the chunk speaks for, cut by hash range (order 3)."""

    def count(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, sizes = _tokens(texts_of(docs.column("text").combine_chunks()))
        before = _histories(tokens, sizes)
        _, at = np.unique(_pair(before, tokens), return_index=True)
        histories, back = np.unique(before, return_inverse=True)
        speaks = (_told(answers, 2) & 1).astype(bool)
        types = np.bincount(back[at[speaks]], minlength=len(histories))
        return _cut(docs.column("chunk")[0].as_py(), 3, histories, types, ranges)

    return count


class Weights:
    """What a traversal needs beside the counts: sums of the corpus, and successor types by history."""

    def __init__(self, n: int, v: int, once: int, twice: int, types: np.ndarray):
        self.n, self.v = n, v
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        self.types = K * types

    def unigram(self, count: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(count))
        return np.where(count > 0, count - self.discount, self.discount * self.v) / self.n

    def arc(self, history: np.ndarray, count: np.ndarray, pair: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """log10 of the arc of a state where it has one, else failure to the root and the arc there."""
        types = self.types[history]
        fail = np.where(count > 0, types / np.maximum(count + types, 1), 1.0)
        return np.log10(np.where(pair > 0, (1 - fail) * pair / np.maximum(count, 1) + fail * unigram, fail * unigram))


def _traverse(*corpus: int):
    """Scores of the documents of a chunk from the answers to it; ``corpus``: n, v, once, twice."""

    def traverse(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tokens, sizes = _tokens(texts_of(docs.column("text").combine_chunks()))
        before = _histories(tokens, sizes)
        # The sheets of words, pairs and histories: numbers of the distinct ones, and the place of each token's.
        distinct, back = np.unique(tokens, return_inverse=True)
        counts = _told(answers, 1) >> 1
        word, ends = counts[back], counts[np.searchsorted(distinct, END)]
        pair = (_told(answers, 2) >> 1)[np.unique(_pair(before, tokens), return_inverse=True)[1]]
        weights = Weights(*corpus, _told(answers, 3) >> 1)
        # The word before, or as many beginnings as there are ends.
        state = np.concatenate(([0], word[:-1]))
        begin = np.cumsum(sizes) - sizes
        state[begin] = ends
        score = weights.arc(np.unique(before, return_inverse=True)[1], state, pair, weights.unigram(word))
        base = np.log10((word + 0.5) / (weights.n + 0.5 * (weights.v + 1)))
        add = lambda x: np.add.reduceat(x, begin)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(sizes),
            "n_known": pa.array(add((word > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(sizes), weights.n)),
            "base_score": pa.array(add(base)), "score": pa.array(add(score)),
        })

    return traverse


def score_texts(docs: DataFrame) -> DataFrame:
    """Learn from the documents outside the held-out fold and score every row of ``docs``.

    One row per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).
    A null text is empty (its end token alone is scored), repeated rows count and are scored
    each, a null doc_id is learned from, other columns are ignored. Without training text the
    unknown word has probability 1.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), text.alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(8, -(-size // CHUNK_BYTES))
    ranges = max(4, -(-size // (10 * RANGE_ENTRIES)))
    dealt = slim.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    dealt = materialise(dealt.repartition("chunk").sortWithinPartitions("chunk"))
    drop_finished(spark)
    asked = dealt.select("chunk", "text", "held_out").mapInArrow(_requests(ranges), _KEYS_DDL)
    answers = materialise(asked.groupBy("order", "range").applyInArrow(_answers, _ANSWERS))
    del asked
    drop_finished(spark)
    corpus = [x or 0 for x in answers.agg(*[F.sum(x) for x in ("n", "v", "once", "twice")]).first()]
    told = answers.select("chunk", "order", "range", "counts")
    texts = dealt.select("chunk", "text").groupBy("chunk")
    spoken = texts.cogroup(told.where("order = 2").groupBy("chunk")).applyInArrow(_successors(max(4, ranges // 8)), _KEYS_DDL)
    types = materialise(spoken.groupBy("order", "range").applyInArrow(_answers, _ANSWERS))
    del spoken, texts
    drop_finished(spark)
    told = told.unionByName(types.select("chunk", "order", "range", "counts"))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_traverse(*corpus), out)


def op4_backoff_automaton(spark, folder: str) -> DataFrame:
    """Language-model scores of all documents."""
    return score_texts(table(spark, folder, "documents"))
