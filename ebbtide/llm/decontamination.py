"""Benchmark decontamination: passages as queries against a BM25 index of the test items.

The index holds a block of at most ``INDEX_ITEMS`` items, or ``INDEX_BYTES`` of text, at a time, so its size is bounded whatever the
benchmark; documents pass by each block. Document frequencies and the mean length are those of the
whole benchmark, so scores do not depend on the blocks. An item's BM25 weights are divided by the score that
its own text gets, so one threshold serves all items. Items lie in groups; the largest weight of
a term in each group bounds the score of all its items. A passage is a window of twice the
longest item, every item length, so that any occurrence lies inside one. Groups whose bound for a
passage stays below the threshold are skipped; the items of the others are scored exactly. What
reaches the threshold is verified: enough of the question and of the answer must stand in the
passage, as n-grams or as words in order where the item lies, which an edited word hardly lowers.
The answer is the last quarter of an item's words, the question what is before it. Items of few
words are looked for as whole word sequences.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import hashed, keyed, materialise, narrow, table, texts_of, windows

K1, B = 1.2, 0.75
#: Thresholds: share of an item's own score, of its question, of its answer.
SCORE, QUESTION, ANSWER = 0.6, 0.6, 0.6
GRAM = 4
#: Words in order may stand so many places off where the item lies.
SLACK = 3
#: Shorter items are found only as they are, word by word.
LEAST_WORDS = 8
INDEX_ITEMS, INDEX_BYTES, GROUP = 512, 1 << 18, 8
ANSWER_SHARE = 0.25

#: Letters and digits make words; marks around them do not count.
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = 1


@dataclass
class Index:
    ids: list[int | None]
    terms: np.ndarray  # sorted hashes
    bounds: np.ndarray  # terms x groups: largest weight of the group's items
    weights: np.ndarray  # terms x items
    question: list[np.ndarray]  # per item: distinct n-grams
    answer: list[np.ndarray]
    words: list[np.ndarray]
    cuts: list[int]  # words of the question
    short: dict[int, dict[int, list[int]]]  # by number of words and their hash: places in ids
    longest: int


@dataclass
class Statistics:
    """Of the items with ``LEAST_WORDS`` words or more of a benchmark."""

    items: int
    mean: float
    found: dict[int, int]  # items that hold a word, at least for the words of the block at hand


def build_index(items: list[tuple[int | None, bytes]], statistics: Statistics | None = None) -> Index | None:
    """BM25 weights of a bounded block of items; None if none has words.

    Without ``statistics`` the block is the whole benchmark.
    """
    words = [v[a:b] for _, v, o in hashed([t for _, t in items], _CLASSES) for a, b in zip(o[:-1], o[1:], strict=True)]
    named = [(i, w) for (i, _), w in zip(items, words, strict=True) if len(w)]
    if not named:
        return None
    kept = [x for x in named if len(x[1]) >= LEAST_WORDS]
    ids, short = [i for i, _ in kept], {}
    for i, w in named:
        if len(w) < LEAST_WORDS:
            short.setdefault(len(w), {}).setdefault(int(windows(w, len(w))[0]), []).append(len(ids))
            ids.append(i)
    if not kept:
        return Index(ids, np.zeros(0, np.uint64), None, None, [], [], [], [], short, 0)
    terms, found = np.unique(np.concatenate([np.unique(w) for _, w in kept]), return_counts=True)
    total, mean = len(kept), np.mean([len(w) for _, w in kept])
    if statistics is not None:
        total, mean = statistics.items, statistics.mean
        found = np.array([statistics.found[t] for t in terms.tolist()])
    idf = np.log(1 + (total - found + 0.5) / (found + 0.5))
    index = Index(ids, terms, None, np.zeros((len(terms), len(kept)), np.float32), [], [], [w for _, w in kept], [], short, max(len(w) for _, w in kept))
    for k, (_, w) in enumerate(kept):
        own, tf = np.unique(w, return_counts=True)
        row = np.searchsorted(terms, own)
        weight = idf[row] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
        index.weights[row, k] = weight / weight.sum()
        cut = len(w) - max(GRAM, int(len(w) * ANSWER_SHARE))
        index.cuts.append(cut)
        index.question.append(np.unique(windows(w[: cut + GRAM - 1], GRAM)))
        index.answer.append(np.unique(windows(w[cut:], GRAM)))
    index.bounds = np.maximum.reduceat(index.weights, np.arange(0, len(kept), GROUP), axis=1)
    return index


def _longest_rise(places: np.ndarray) -> int:
    ends: list[int] = []
    for p in places.tolist():
        at = bisect_left(ends, p)
        ends[at : at + 1] = [p]
    return len(ends)


def in_order(item: np.ndarray, cut: int, passage: np.ndarray, overlap: list[float]) -> list[float]:
    """``overlap`` of question and answer, raised to the shares of their words that stand in order
    around a place of the passage, where that makes both enough."""
    least = QUESTION * cut + ANSWER * (len(item) - cut)
    i, j = np.nonzero(item[:, None] == passage[None, :])
    lane = j - i + len(item) - 1
    single = np.bincount(lane, minlength=len(item) + len(passage) + 2 * SLACK)
    around = np.convolve(single, np.ones(2 * SLACK + 1, np.int64), "same")
    # No lane with fewer equal words around it can hold enough of both.
    possible = np.flatnonzero((single > 0) & (around >= least))
    for d in possible[np.argsort(-single[possible], kind="stable")]:
        near = np.abs(lane - d) <= SLACK
        p, q = i[near], j[near]
        order = np.lexsort((-q, p))
        p, q = p[order], q[order]
        share = [_longest_rise(q[p < cut]) / cut, _longest_rise(q[p >= cut]) / (len(item) - cut)]
        share = [max(x) for x in zip(overlap, share, strict=True)]
        if share[0] >= QUESTION and share[1] >= ANSWER:
            return share
    return overlap


def _sequences(words: np.ndarray, offsets: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, float, float, float]]:
    """As ``_search``, the items of few words: the first place in each document."""
    for n, wanted in index.short.items():
        known = np.sort(np.fromiter(wanted, np.uint64, len(wanted)))
        have = windows(words, n)
        at = np.flatnonzero(np.isin(have, known))
        doc = np.searchsorted(offsets, at, side="right") - 1
        inside = at + n <= offsets[doc + 1]
        at, doc = at[inside], doc[inside]
        _, first = np.unique(doc * len(known) + np.searchsorted(known, have[at]), return_index=True)
        for d, p in zip(doc[first].tolist(), at[first].tolist(), strict=True):
            for k in wanted[int(have[p])]:
                yield d, k, int(p - offsets[d]), 1.0, 1.0, 1.0


def _search(words: np.ndarray, offsets: np.ndarray, index: Index) -> Iterator[tuple[int, int, int, float, float, float]]:
    """(document, item, first word of the passage, score, question overlap, answer overlap) of all that pass."""
    yield from _sequences(words, offsets, index)
    step = index.longest
    if not step:
        return
    row = np.searchsorted(index.terms, words)
    row[row == len(index.terms)] = 0
    at = np.flatnonzero(index.terms[row] == words)
    if not len(at):
        return
    doc = np.searchsorted(offsets, at, side="right") - 1
    # Windows are numbered through all documents; a word lies in its own and the one before.
    per_doc = -(-np.diff(offsets) // step)
    base = np.cumsum(per_doc) - per_doc
    within = (at - offsets[doc]) // step
    window = base[doc] + within
    earlier = within > 0
    key = np.concatenate((window, window[earlier] - 1)) * len(index.terms) + np.concatenate((row[at], row[at][earlier]))
    key = np.unique(key)  # each term once for a passage
    window, term = key // len(index.terms), key % len(index.terms)
    begin = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
    end = np.append(begin, len(window))[1:]
    for lo in range(0, len(begin), 8192):
        some = begin[lo : lo + 8192]
        last = end[min(lo + 8192, len(begin)) - 1]
        bound = np.add.reduceat(index.bounds[term[some[0] : last]], some - some[0], axis=0)
        for w, g in zip(*np.nonzero(bound >= SCORE - 1e-4), strict=True):
            present = term[begin[lo + w] : end[lo + w]]
            number = window[begin[lo + w]]
            d = int(np.searchsorted(base, number, side="right") - 1)
            start = offsets[d] + (number - base[d]) * step
            grams = None
            scores = index.weights[present, g * GROUP : (g + 1) * GROUP].sum(axis=0, dtype=np.float64)
            for k, score in ((g * GROUP + j, scores[j]) for j in np.flatnonzero(scores >= SCORE)):
                if grams is None:
                    passage = words[start : min(start + 2 * step, offsets[d + 1])]
                    grams = np.unique(windows(passage, GRAM))
                overlap = [float(np.isin(x[k], grams, assume_unique=True).mean()) for x in (index.question, index.answer)]
                if overlap[0] < QUESTION or overlap[1] < ANSWER:
                    overlap = in_order(index.words[k], index.cuts[k], passage, overlap)
                if overlap[0] >= QUESTION and overlap[1] >= ANSWER:
                    yield d, k, int(start - offsets[d]), float(score), *overlap


_FOUND = "doc_id long, item_id long, passage long, score double, question_overlap double, answer_overlap double"


def _passages(index: Index):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _FOUND.replace(",", "").split()[::2]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        for b in batches:
            ids = b.column(0).to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            for first, words, offsets in hashed(texts_of(b.column(1)), _CLASSES):
                for d, k, *rest in _search(words, offsets, index):
                    key = (first + d, k)
                    if key not in best or rest[1] > best[key][1]:
                        best[key] = tuple(rest)
            rows = [(ids[d], index.ids[k], *rest) for (d, k), rest in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return find


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and distinct words of the items that are not short."""
    for b in batches:
        found = [v[x:y] for _, v, o in hashed(texts_of(b.column(1)), _CLASSES) for x, y in zip(o[:-1], o[1:], strict=True)]
        some = [k for k, w in enumerate(found) if len(w) >= LEAST_WORDS]
        if some:
            arrays = [b.column(0).take(pa.array(some)), pa.array([len(found[k]) for k in some], pa.int64()),
                      pa.array([np.unique(found[k]).view(np.int64) for k in some], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n", "words"])


def _blocks(items: DataFrame) -> Iterator[tuple[list[tuple[int | None, bytes]], Statistics]]:
    """Blocks of the items in order of item_id, with what the whole benchmark says about their words."""
    numbered = keyed(items.select(F.col("item_id").cast("long"), F.col("text").cast("string")))
    sheet = materialise(numbered.select("row", "doc.text").mapInArrow(_item_words, "row long, n long, words array<long>"))
    held = sheet.agg(F.count(F.lit(1)), F.sum("n")).first()
    each = sheet.select("row", F.explode("words").alias("word"))
    often = materialise(each.groupBy("word").agg(F.count(F.lit(1)).alias("found")))
    known = narrow(each, often, "word").groupBy("row").agg(F.collect_list(F.struct("word", "found")).alias("known"))
    block: list[tuple[int | None, bytes]] = []
    found: dict[int, int] = {}
    size = 0
    for r in numbered.join(known, "row", "left").orderBy("doc.item_id", "row").select("doc.item_id", "doc.text", "known").toLocalIterator():
        block.append((r[0], (r[1] or "").encode()))
        found |= {word % (1 << 64): n for word, n in r[2] or []}
        size += len(block[-1][1])
        if len(block) == INDEX_ITEMS or size >= INDEX_BYTES:
            yield block, Statistics(held[0], held[1] / held[0] if held[0] else 0.0, found)
            block, found, size = [], {}, 0
    if block:
        yield block, Statistics(held[0], held[1] / held[0] if held[0] else 0.0, found)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and item of ``benchmark`` (item_id, text) that stands in it.

    doc_id, item_id, passage (its first word), score (share of the item's own BM25 score),
    question_overlap, answer_overlap (share of n-grams, or of words in order); of several passages
    the best. Items with fewer than ``LEAST_WORDS`` words stand in a text only with all their words
    together, be it one; passage is then their place, and the shares are 1. Null and empty texts
    leak nothing; items without words are not searched for, those without an id come with a null
    item_id; repeated rows each give their rows; other columns are ignored.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = docs.sparkSession.createDataFrame([], _FOUND)
    for block, statistics in _blocks(benchmark):
        if (index := build_index(block, statistics)) is not None:
            out = out.union(slim.mapInArrow(_passages(index), _FOUND))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item stands, with their columns.

    Each row is judged by its own text: a doc_id may be null or stand for several texts.
    """
    numbered = keyed(docs)
    found = leaks(numbered.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")), benchmark)
    found = materialise(found.select(F.col("doc_id").alias("row")).distinct())
    return narrow(numbered, found, "row", "left_anti").select("doc.*")


def op3_bm25_decontamination(spark, folder: str) -> DataFrame:
    """Every document and test item that stands in it."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
