"""Removal of long byte strings that stand more than once, by suffix arrays over shards.

A string of 400 bytes can stand in any two documents, so texts are dealt by content. Every
window of that length has an anchor, the least hash of the 16-byte grams inside it; equal
windows have equal anchors. Windows that follow each other under one anchor are a block (a
few hundred bytes), and a block whose anchor stands nowhere else cannot hold a repeat. Equal
blocks are counted and kept once. The others go by anchor to shards of bounded size, each of
which builds a suffix array by induced sorting and its permuted common prefixes: neighbours in
the array that share 400 bytes are one string, which stands as often as the blocks that hold it.

Where one anchor has more blocks than a task should take (the edges of a passage that very many
documents share), its windows are counted by a 128-bit digest instead, which spreads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import batch, materialise, mix, table, texts_of
from ebbtide.llm.suffixes import common_prefixes, suffix_array, words_at

#: Bytes of a string that must not stand twice, and of the grams whose least hash is an anchor.
SPAN, GRAM = 400, 16
#: Bytes of blocks per shard, and of one anchor's blocks beyond which its windows are counted by digest.
SHARD, ANCHOR = 4 << 20, 8 << 20
#: Windows per part of a long text, and bytes of parts that are hashed together.
PART, BUFFER = 1 << 18, 1 << 19

#: Low bits of a gram's hash give way to its place, so that one least value names the gram and the place.
_PLACE = np.uint64((1 << 20) - 1)
#: Between blocks of a shard; stands in no UTF-8 text, and would do no harm if it did.
_GAP = b"\xff"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row: the end of one tile and the start of the next."""
    n = len(values)
    rows = -(-n // width)
    tiles = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    tiles[:n] = values
    tiles = tiles.reshape(rows, width)
    ahead = np.minimum.accumulate(tiles, axis=1).ravel()
    back = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _parts(texts: list[bytes], span: int) -> Iterator[tuple[list[tuple[int, int]], bytes]]:
    """Buffers of parts of texts: (text, first byte) of each part; windows of a text are in one part each."""
    held, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for start in range(0, len(t) - span + 1, PART):
            held.append((i, start))
            parts.append(t[start : start + PART + span - 1])
            size += len(parts[-1])
            if size >= BUFFER:
                yield held, parts
                held, parts, size = [], [], 0
    if held:
        yield held, parts


def blocks(parts: list[bytes], span: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Blocks of windows under one anchor: part, first byte in it, windows, anchor, whether its gram stands twice in it."""
    text = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    begin = np.cumsum(sizes) - sizes
    words = words_at(text)
    head = words[: len(text) - gram + 1] * np.uint64(0x9E3779B97F4A7C15)
    grams = mix(head ^ mix(words[gram - 8 : len(text) - 8 + 1])) & ~_PLACE
    place = np.arange(len(grams), dtype=np.uint64)
    width = span - gram + 1
    first_least, last_least = _least(grams | place, width), _least(grams | (_PLACE - place), width)
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, begin, 1)
    np.add.at(inside, begin + sizes - span + 1, -1)
    at = np.flatnonzero(np.cumsum(inside)[: len(first_least)] > 0)
    anchor = first_least[at] >> np.uint64(20)
    fresh = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (anchor[1:] != anchor[:-1]))))
    first, last = at[fresh], at[np.append(fresh[1:], len(at)) - 1]
    twice = (first_least[first] & _PLACE) != (_PLACE - (last_least[last] & _PLACE))
    part = np.searchsorted(begin, first, side="right") - 1
    return part, first - begin[part], last - first + 1, anchor[fresh].astype(np.int64), twice


_BLOCK = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("windows", pa.int32()), ("anchor", pa.int64()), ("twice", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64())])
_BLOCK_DDL = "row long, start long, windows int, anchor long, twice boolean, d1 long, d2 long"


def _digests(strings: Iterator[bytes]) -> np.ndarray:
    """Two signed 64-bit integers per string."""
    return np.frombuffer(b"".join([hashlib.blake2b(s, digest_size=16).digest() for s in strings]), np.int64).reshape(-1, 2)


def _blocks_of_rows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, texts = b["row"].to_numpy(), texts_of(b["text"])
            for held, parts in _parts(texts, span):
                part, start, windows, anchor, twice = blocks(parts, span)
                digest = _digests(parts[p][s : s + w + span - 1] for p, s, w in zip(part.tolist(), start.tolist(), windows.tolist()))
                of, offset = np.array(held).T
                columns = {"row": rows[of[part]], "start": start + offset[part], "windows": windows, "anchor": anchor, "twice": twice}
                yield batch(columns | {"d1": digest[:, 0], "d2": digest[:, 1]}, _BLOCK)

    return run


_TEXT = pa.schema([("shard", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("crowded", pa.bool_()), ("text", pa.binary())])
_TEXT_DDL = "shard long, d1 long, d2 long, n long, crowded boolean, text binary"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the blocks that ``wanted`` names in each text."""
    for b in batches:
        wanted, texts = b["wanted"], texts_of(b["text"])
        flat, sizes = wanted.flatten(), np.diff(wanted.offsets.to_numpy())
        columns = {f.name: flat.field(f.name) for f in _TEXT if f.name != "text"}
        cuts = zip(np.repeat(np.arange(len(texts)), sizes).tolist(), flat.field("start").to_pylist(), flat.field("size").to_pylist())
        yield batch(columns | {"text": [texts[i][s : s + n] for i, s, n in cuts]}, _TEXT)


_FOUND = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32()))])
_FOUND_DDL = "d1 long, d2 long, first array<int>, last array<int>"


def repeats(texts: list[bytes], counts: np.ndarray, span: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text, first and last start of every run of windows that occur more than once; a text stands ``counts`` times."""
    text = np.frombuffer(_GAP.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes + 1) - sizes - 1
    words = words_at(text)
    order = suffix_array(text, words)
    shared = common_prefixes(text, order, words)
    weight = np.zeros(len(text), np.int64)
    for b, s, c in zip(begin.tolist(), sizes.tolist(), counts.tolist()):
        weight[b : b + s - span + 1] = c
    fresh = shared[order] < span
    fresh[0] = True
    starts = np.flatnonzero(fresh)
    total = np.add.reduceat(weight[order], starts)
    times = np.empty(len(text), np.int64)
    times[order] = np.repeat(total, np.diff(np.append(starts, len(text))))
    at = np.flatnonzero((times > 1) & (weight > 0))
    of = np.searchsorted(begin, at, side="right") - 1
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (of[1:] != of[:-1])))) if len(at) else np.zeros(0, np.int64)
    first, last, of = at[edge], at[np.append(edge[1:], len(at)) - 1] if len(at) else at, of[edge]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [(first[a:b] - begin[i], last[a:b] - begin[i]) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]


def _shard(span: int):
    def run(shard: pa.Table) -> pa.Table:
        found = repeats(shard["text"].to_pylist(), shard["n"].to_numpy(), span)
        keep = np.array([len(f) > 0 for f, _ in found])
        out = [shard["d1"].filter(pa.array(keep)), shard["d2"].filter(pa.array(keep))]
        out += [pa.array([x[k] for x in found if len(x[0])], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.table(out, schema=_FOUND)

    return run


_WINDOW_DDL = "d1 long, d2 long, n long, place int, w1 long, w2 long"
_WINDOW = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("place", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])


def _windows(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d1, d2, n, t in zip(*(b[c].to_pylist() for c in ("d1", "d2", "n", "text"))):
                digest = _digests(t[i : i + span] for i in range(len(t) - span + 1))
                k = len(digest)
                columns = {"d1": np.full(k, d1), "d2": np.full(k, d2), "n": np.full(k, n), "place": np.arange(k), "w1": digest[:, 0], "w2": digest[:, 1]}
                yield batch(columns, _WINDOW)

    return run


def _crowded(texts: DataFrame, span: int) -> DataFrame:
    """What ``_shard`` returns, for blocks of anchors that have too many: every window by its digest."""
    windows = materialise(texts.where("crowded").select("d1", "d2", "n", "text").mapInArrow(_windows(span), _WINDOW_DDL))
    often = windows.groupBy("w1", "w2").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    places = windows.join(often, ["w1", "w2"]).groupBy("d1", "d2").agg(F.sort_array(F.collect_list("place")).alias("first"))
    return places.select("d1", "d2", "first", F.col("first").alias("last"))


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
    ("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])
_RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, end: long>>"


def _removed(span: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {f.name: [] for f in _RESULT}
            for doc_id, t, found in zip(b["doc_id"].to_pylist(), texts_of(b["text"]), b["found"]):
                spans = []
                if found.is_valid:
                    runs = found.values
                    sizes = np.diff(runs.field("first").offsets.to_numpy())
                    start = np.repeat(runs.field("start").to_numpy(), sizes)
                    first = start + runs.field("first").flatten().to_numpy()
                    last = start + runs.field("last").flatten().to_numpy() + span
                    order = np.argsort(first, kind="stable")
                    first, last = first[order], np.maximum.accumulate(last[order])
                    edge = np.flatnonzero(np.concatenate(([True], first[1:] > last[:-1])))
                    spans = list(zip(first[edge].tolist(), last[np.append(edge[1:], len(first)) - 1].tolist()))
                ends = [0, *(e for _, e in spans)]
                kept = b"".join([t[a:b] for a, b in zip(ends, [*(s for s, _ in spans), len(t)])])
                row = (doc_id, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_text else None)
                for name, value in zip(out, (*row, [{"start": s, "end": e} for s, e in spans] if with_text else None)):
                    out[name].append(value)
            yield batch(out, _RESULT)

    return run


def remove_repeats(docs: DataFrame, span: int = SPAN, text: bool = False, shard: int = SHARD, anchor: int = ANCHOR) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) without the bytes of strings that stand more than once.

    A byte goes if it lies in a string of ``span`` bytes that starts anywhere else too, in the
    same text or another; texts are judged as given, and strings never reach from one text into
    the next. Returns ``doc_id, n_bytes, n_removed, n_spans`` (longest removed runs) and
    ``kept_sha256`` of the remaining bytes; with ``text`` also those bytes as ``kept`` (they may
    cut a character) and the removed ``spans``, else both are null.

    Null and empty texts, and texts shorter than ``span``, lose nothing. Rows are told apart by
    a key of their own: repeated rows are repeats of each other and lose all their long texts,
    null ids and several texts under one id stay rows of their own. Other columns are ignored.
    ``span`` is 32 at least. Empty tables give empty results.
    """
    if span < 2 * GRAM:
        raise ValueError(f"span must be at least {2 * GRAM}")
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    made = materialise(rows.where(F.octet_length("text") >= span).select("row", "text").mapInArrow(_blocks_of_rows(span), _BLOCK_DDL))
    shared = made.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), F.max("twice").alias("twice")).where("times > 1 or twice")
    candidates = materialise(made.drop("twice").join(shared.select("anchor"), "anchor"))
    size = F.col("windows") + (span - 1)
    kinds = candidates.groupBy("d1", "d2").agg(
        F.count(F.lit(1)).alias("n"), F.first("anchor").alias("anchor"), F.first(size).alias("size"), F.min(F.struct("row", "start")).alias("at")
    )
    kinds = materialise(kinds)
    total = kinds.agg(F.sum("size")).first()[0] or 0
    # One line per ``anchor`` bytes at most. Written, it is known to be small, so no shuffle brings an anchor's blocks into one task.
    held = kinds.groupBy("anchor").agg(F.sum("size").alias("held"))
    crowds = materialise(held.where(F.col("held") > anchor).select("anchor", F.lit(True).alias("crowded")))
    crowded = F.coalesce("crowded", F.lit(False))
    shard_of = F.pmod(F.xxhash64("anchor"), F.lit(total // shard + 1))
    wanted = kinds.join(crowds, "anchor", "left").groupBy(F.col("at.row").alias("row")).agg(
        F.collect_list(F.struct(shard_of.alias("shard"), "d1", "d2", "n", crowded.alias("crowded"), F.col("at.start").alias("start"), "size")).alias("wanted")
    )
    texts = materialise(rows.join(wanted, "row").select("text", "wanted").mapInArrow(_cut_out, _TEXT_DDL))
    found = texts.where("not crowded").groupBy("shard").applyInArrow(_shard(span), _FOUND_DDL)
    if not crowds.isEmpty():
        found = found.unionByName(_crowded(texts, span))
    found = materialise(found)
    placed = candidates.select("row", "start", "d1", "d2").join(found, ["d1", "d2"])
    by_row = placed.groupBy("row").agg(F.collect_list(F.struct("start", "first", "last")).alias("found"))
    return rows.join(by_row, "row", "left").select("doc_id", "text", "found").mapInArrow(_removed(span, text), _RESULT_DDL)


def op11_repeated_spans(spark, folder: str) -> DataFrame:
    """All documents without strings of 400 bytes that stand more than once."""
    return remove_repeats(table(spark, folder, "documents")).drop("kept", "spans")
