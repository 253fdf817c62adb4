"""Token counts under a unigram model, one forward pass per shared prefix.

The vocabulary is that of a public piece file. Its pieces are ordered by rank; the model gives
rank r the probability of Zipf's law, 1 / (r + 2.7), in fixed point, so that sums do not depend
on their order. A pre-token is a word after the mark that stands for its space. Distinct
pre-tokens that a worker has not met go into a trie; the forward scores of a node need only those
of its ancestors, so each shared prefix is computed once, and the terminal nodes give the counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import chunks, table, texts_of
from ebbtide.llm.vocab import CACHE_BYTES, CACHE_WORDS, default_path

SPACE = "▁"
#: Fixed point of a cost. Within a word the cost stands above the count, so that the least value
#: is the least cost with the fewest tokens; over a text the count stands above the cost.
UNIT, STEP, COUNT = 1 << 10, 1 << 28, 1 << 48
#: Bytes of text whose new words are learned together, and new words that share one trie.
TRIE_BYTES = 1 << 21
TRIE_WORDS = 100_000


class _Known(dict):
    """Word -> packed value; words too long to keep are computed each time."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, word: bytes) -> int:
        return self.compute(word)


class Unigram:
    """Least cost, then fewest tokens, of any segmentation into pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        shift = math.log(sum(1 / (r + 2.7) for r in range(len(names))))
        cost = {name: round(UNIT * (math.log(r + 2.7) + shift)) * STEP + 1 for r, (_, name) in enumerate(names)}
        #: A character outside the vocabulary costs its bytes, each as dear as the rarest piece.
        self.byte = max(cost.values())
        self.longest = max(map(len, cost))
        #: Value of every piece, and 0 for what only ends pieces: beyond these no piece ends here.
        self.ends = {name[k:]: 0 for name in cost for k in range(len(name))} | cost
        self.known = _Known(self.word)

    def step(self, path: str, best: list[int]) -> int:
        """Least value for ``path`` from those of its prefixes."""
        ends, n = self.ends.get, len(path)
        found = 0
        for k in range(n - 1, -1, -1):
            value = ends(path[k:])
            if value is None:
                break
            if value and (not found or best[k] + value < found):
                found = best[k] + value
        if not ends(path[-1]):
            unknown = best[n - 1] + self.byte * len(path[-1].encode())
            found = min(found, unknown) if found else unknown
        return found

    def word(self, word: bytes) -> int:
        """Without a trie, for one word."""
        text, best = SPACE + word.decode(), [0]
        for i in range(len(text)):
            # Only the last characters matter; a long word is not copied again for each of them.
            low = max(0, i + 1 - self.longest)
            best.append(self.step(text[low : i + 1], best[low:]))
        return best[-1] % STEP * COUNT + best[-1] // STEP

    def learn(self, words: list[bytes]) -> None:
        """Insert ``words`` in a trie and store the value of each terminal node."""
        root: dict = {}
        for word in words:
            node = root
            for c in SPACE + word.decode():
                node = node.setdefault(c, {})
            node[""] = word
        # Depth first; path and best hold the characters and values down to the current node.
        path, best, stack = "", [0], [(0, "", root)]
        while stack:
            depth, char, node = stack.pop()
            if char:
                path = path[: depth - 1] + char
                del best[depth:]
                best.append(self.step(path, best))
            for c, child in node.items():
                if c:
                    stack.append((depth + 1, c, child))
                else:
                    self.known[child] = best[-1] % STEP * COUNT + best[-1] // STEP

    def count(self, texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """Words, tokens and cost of each text."""
        for start, end in chunks(texts, TRIE_BYTES):
            split = [t.split() for t in texts[start:end]]
            new = [w for w in set().union(*split) if len(w) <= CACHE_BYTES and w not in self.known]
            if len(self.known) + len(new) > CACHE_WORDS:
                self.known.clear()
                new = [w for w in set().union(*split) if len(w) <= CACHE_BYTES]
            for at in range(0, len(new), TRIE_WORDS):
                self.learn(new[at : at + TRIE_WORDS])
            for words in split:
                total = sum(map(self.known.__getitem__, words))
                yield len(words), total // COUNT, total % COUNT


_open: dict[str, Unigram] = {}


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_tokens, log_prob.

    Whole texts, null as empty (0 tokens); repeated rows each give a row; other columns are
    ignored. No shuffle: a worker keeps the counts of up to ``CACHE_WORDS`` words.
    """
    path = path or default_path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _open.get(path) or _open.setdefault(path, Unigram(path))
        for b in batches:
            rows = list(model.count(texts_of(b.column(1))))
            words, tokens, cost = zip(*rows, strict=True) if rows else ((), (), ())
            columns = [b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64()), pa.array([-c / UNIT for c in cost], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "log_prob"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_words long, n_tokens long, log_prob double")


def op1_trie_token_counts(spark, folder: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(table(spark, folder, "documents"))
