"""Token ids in files of grammar-compressed blocks (Re-Pair).

A block holds whole documents of about ``BLOCK`` tokens. Rounds over a block count the pairs of
adjacent symbols, turn the frequent ones into rules, and replace them from left to right, until
little is left to gain. No pair reaches over the end of a document, so every document begins at
a symbol, and the expansion lengths of the rules lead to any token without decoding what is
before it. Blocks are rows of a Parquet table that Spark writes and commits.

Columns: ``part``, ``block`` (order of the blocks), ``before`` (tokens of earlier blocks of the
part), ``n_tokens``, and as little-endian arrays ``rules`` (uint16 pairs; rule i is symbol
``FIRST_RULE`` + i), ``lengths`` (uint32 expansion length per rule), ``symbols`` (uint16),
``doc_ids`` (int64; ``doc_nulls`` holds one byte each), ``doc_symbols`` and ``doc_tokens``
(uint32, first symbol and first token of each document).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import batch, short_batches, table, texts_of
from ebbtide.llm.vocab import ByteLevel, default_path, encoder
from ebbtide.session import shared_folder

END_ID = 2
BLOCK = 1 << 20
FIRST_RULE = 50_257
#: Symbols are 16 bits wide, which bounds the rules of a block.
MOST_RULES = (1 << 16) - FIRST_RULE
_ROUND_RULES = 4096
_LEAST_COUNT = 12
_LEAST_GAIN = 0.04
_SLOTS = 18

_BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("rules", pa.binary()),
    ("lengths", pa.binary()), ("symbols", pa.binary()), ("doc_ids", pa.binary()), ("doc_nulls", pa.binary()),
    ("doc_symbols", pa.binary()), ("doc_tokens", pa.binary()),
])
_BLOCK_DDL = (
    "part int, block int, before long, n_tokens long, rules binary, lengths binary, symbols binary, "
    "doc_ids binary, doc_nulls binary, doc_symbols binary, doc_tokens binary"
)
#: A row is about a megabyte: pages and row groups end by their size after any row, not after a hundred at the least.
_FILES = {"parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size": 16 << 20}


def compress(tokens: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (uint16) and rules (n x 2, uint16) whose expansion is ``tokens``."""
    seq, rules = tokens.astype(np.uint16), [np.zeros((0, 2), np.uint16)]
    count = 0
    closing = np.zeros(1 << 16, bool)  # symbols whose last token ends a document
    closing[end_id] = True
    while count < MOST_RULES and len(seq) > 1:
        keys = (seq[:-1].astype(np.uint32) << np.uint32(16)) | seq[1:]
        ordered = np.sort(keys[~closing[seq[:-1]]])
        edge = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
        many = np.diff(np.append(edge, len(ordered)))
        frequent = np.flatnonzero(many >= _LEAST_COUNT)
        best = frequent[np.argsort(-many[frequent], kind="stable")][: min(_ROUND_RULES, MOST_RULES - count)]
        chosen = ordered[edge[best]]
        # A table of slots finds the chosen pairs; of two that meet in a slot the rarer waits.
        slot = (chosen * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)
        _, first = np.unique(slot, return_index=True)
        chosen, slot = chosen[np.sort(first)], slot[np.sort(first)]
        if not len(chosen):
            break
        number = np.full(1 << _SLOTS, -1, np.int32)
        number[slot] = np.arange(len(chosen))
        found = number[(keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS)]
        at = np.flatnonzero(found >= 0)
        at = at[chosen[found[at]] == keys[at]]
        # Neighbouring occurrences overlap: every second one of a row of neighbours is taken.
        row = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - row) % 2 == 0]
        closing[FIRST_RULE + count : FIRST_RULE + count + len(chosen)] = closing[chosen & np.uint32(0xFFFF)]
        rules.append(np.stack([chosen >> np.uint32(16), chosen & np.uint32(0xFFFF)], axis=1).astype(np.uint16))
        new = seq.copy()
        new[at] = FIRST_RULE + count + found[at]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        count += len(chosen)
        gain = len(at) / len(seq)
        seq = new[keep]
        if gain < _LEAST_GAIN:
            break
    return seq, np.concatenate(rules)


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Tokens that each symbol stands for, terminals included."""
    lengths = np.ones(FIRST_RULE + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist(), FIRST_RULE):
        lengths[i] = lengths[a] + lengths[b]
    return lengths


class Block:
    """One decoded row of the block table."""

    def __init__(self, row: dict):
        self.symbols = np.frombuffer(row["symbols"], "<u2")
        self.rules = np.frombuffer(row["rules"], "<u2").reshape(-1, 2)
        own = np.frombuffer(row["lengths"], "<u4")
        self.lengths = np.concatenate((np.ones(FIRST_RULE, np.int64), own.astype(np.int64)))
        nulls = np.frombuffer(row["doc_nulls"], np.uint8)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(np.frombuffer(row["doc_ids"], "<i8"), nulls, strict=True)]
        self.doc_symbols = np.append(np.frombuffer(row["doc_symbols"], "<u4"), len(self.symbols)).astype(np.int64)
        self.doc_tokens = np.append(np.frombuffer(row["doc_tokens"], "<u4"), row["n_tokens"]).astype(np.int64)
        self._flat: np.ndarray | None = None

    def _rules_in_full(self) -> None:
        """Ids of all rules in a row, by replacing rules with their pairs until none is left."""
        ids = np.arange(FIRST_RULE, FIRST_RULE + len(self.rules), dtype=np.int64)
        while (again := ids >= FIRST_RULE).any():
            width = 1 + again.astype(np.int64)
            at = (np.cumsum(width) - width)[again]
            pairs = self.rules[ids[again] - FIRST_RULE]
            ids = np.repeat(ids, width)
            ids[at], ids[at + 1] = pairs[:, 0], pairs[:, 1]
        own = self.lengths[FIRST_RULE:]
        self._flat = np.concatenate((np.arange(FIRST_RULE), ids)).astype("<u4")
        self._begin = np.concatenate((np.arange(FIRST_RULE), FIRST_RULE + np.cumsum(own) - own))

    def _bytes_of(self, first: int, last: int) -> bytes:
        """Ids behind the symbols ``first`` to ``last``."""
        if self._flat is None:
            self._rules_in_full()
        symbols = self.symbols[first:last]
        width = self.lengths[symbols]
        shift = self._begin[symbols] - (np.cumsum(width) - width)
        return self._flat[np.repeat(shift, width) + np.arange(int(width.sum()))].tobytes()

    def document(self, i: int, n: int = 1) -> bytes:
        """Ids of the i-th document of the block, or of ``n`` documents from there on."""
        return self._bytes_of(self.doc_symbols[i], self.doc_symbols[i + n])

    def tokens(self, start: int, stop: int) -> bytes:
        """Ids ``start`` to ``stop`` of the block, expanding only the symbols that hold them."""
        ends = np.cumsum(self.lengths[self.symbols])
        first = int(np.searchsorted(ends, start, side="right"))
        last = int(np.searchsorted(ends, stop, side="left")) + 1
        skipped = int(ends[first - 1]) if first else 0
        return self._bytes_of(first, last)[4 * (start - skipped) : 4 * (stop - skipped)]


def _block_row(part: int, number: int, before: int, docs: list, pieces: list[bytes], end_id: int) -> pa.RecordBatch:
    tokens = np.frombuffer(b"".join(pieces), "<u4")
    sizes = np.array([len(p) // 4 for p in pieces], np.int64)
    symbols, rules = compress(tokens, end_id)
    lengths = expansion_lengths(rules)
    ends = np.cumsum(lengths[symbols])
    starts = np.cumsum(sizes) - sizes
    columns = {
        "part": [part], "block": [number], "before": [before], "n_tokens": [len(tokens)],
        "rules": [rules.astype("<u2").tobytes()], "lengths": [lengths[FIRST_RULE:].astype("<u4").tobytes()],
        "symbols": [symbols.astype("<u2").tobytes()],
        "doc_ids": [np.array([d or 0 for d in docs], "<i8").tobytes()], "doc_nulls": [bytes(d is None for d in docs)],
        "doc_symbols": [np.searchsorted(ends, starts, side="right").astype("<u4").tobytes()],
        "doc_tokens": [starts.astype("<u4").tobytes()],
    }
    return batch(columns, _BLOCKS)


def write_ids(docs: DataFrame, target: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Tokenise ``docs`` (doc_id, text) and write them to ``target`` in ascending doc_id order.

    A null text counts as empty, null ids come first, repeated rows are all written; other
    columns are ignored; an empty table gives a table without blocks.
    """
    path, end = path or default_path("byte_bpe_50k.json"), end_id.to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(ByteLevel, path), TaskContext.get().partitionId()
        number = before = held = 0
        ids: list = []
        pieces: list[bytes] = []
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                ids.append(doc_id)
                pieces.append(words.encode(text) + end)
                held += len(pieces[-1]) // 4
                if held >= BLOCK:
                    yield _block_row(part, number, before, ids, pieces, end_id)
                    number, before, held, ids, pieces = number + 1, before + held, 0, [], []
        if ids:
            yield _block_row(part, number, before, ids, pieces, end_id)

    # Position last: rows with one id and one text may lie in several partitions.
    key = F.struct(F.col("doc_id").alias("a"), F.xxhash64("text").alias("b"), F.monotonically_increasing_id().alias("c"))
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn("key_", key)
    ordered = slim.repartitionByRange("key_").sortWithinPartitions("key_").select("doc_id", "text")
    with short_batches(docs.sparkSession):
        ordered.mapInArrow(blocks, _BLOCK_DDL).write.options(**_FILES).parquet(target)


_DOCS_DDL = "doc_id long, part int, at_ long, n_tokens long, ids_crc32 long, ids binary"


def read_ids(spark: SparkSession, target: str, keep_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32, and its ids if wanted.

    ``start`` counts the ids of all documents before it; ids are little-endian 32-bit integers.
    """
    names = _DOCS_DDL.replace(",", "").split()[::2]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):  # a row is a whole block
                row = b.slice(i, 1).to_pylist()[0]
                block = Block(row)
                whole, ends = block.document(0, len(block.doc_ids)), 4 * block.doc_tokens
                ids = [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                n = len(ids)
                values = (
                    pa.array(block.doc_ids, pa.int64()),
                    pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(row["before"] + block.doc_tokens[:-1]),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(ids if keep_ids else [None] * n, pa.binary()),
                )
                yield pa.RecordBatch.from_arrays(list(values), names=names)

    blocks = spark.read.schema(_BLOCK_DDL).parquet(target)
    # One row per part: bounded by the partitions of the writing job.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("all_"))
    starts = parts.select("part", F.coalesce(F.sum("all_").over(ahead), F.lit(0)).alias("ahead_"))
    docs = blocks.mapInArrow(decode, _DOCS_DDL).join(F.broadcast(starts), "part")
    return docs.select("doc_id", (F.col("ahead_") + F.col("at_")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)


def op7_repair_token_files(spark, folder: str) -> DataFrame:
    """Write all documents as grammar-compressed ids, and read the files back."""
    import uuid

    target = f"{shared_folder(spark)}/token_ids/{uuid.uuid4().hex}"
    write_ids(table(spark, folder, "documents"), target)
    return read_ids(spark, target, keep_ids=False)
