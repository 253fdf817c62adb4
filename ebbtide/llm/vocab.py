"""Whole texts to token ids with a public tokenizer file, one library call per distinct word.

Both kinds of file split a text before they merge anything, and no piece of that split reaches
over the places where texts are cut here. A word is therefore looked up in a cache per worker,
and the library sees it once. The cache starts anew beyond ``CACHE_WORDS`` words; words longer
than ``CACHE_BYTES`` are never kept.
"""

from __future__ import annotations

import json
import os
import re

from ebbtide.llm.common import kept_by_worker

CACHE_WORDS = 1_400_000
CACHE_BYTES = 48

#: Code points that count as white space under some definition, but for space and newline.
_EXOTIC = "".join(map(chr, [9, 11, 12, 13, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ODD = re.compile(rf"[{_EXOTIC}]")
#: From one black character followed by plain white space to the next.
_PIECES = re.compile(r"\s*\S+(?:[^\S \t\n\r]\s*\S*)*|\s+")
#: Letters in every version of Unicode, so to each library.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
#: Marks that form a piece of their own after a letter.
_MARKS = b".,!?;:#$%&*|"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Cache(dict):
    """Word -> ids as little-endian 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        self.library = _library(path)
        self.marks: dict[bytes, bytes] = {}

    def ids(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.library.encode(text, add_special_tokens=False).ids)

    def mark(self, marks: bytes) -> bytes:
        if (found := self.marks.get(marks)) is None:
            found = self.ids(marks.decode())
            if len(self.marks) < 10_000:
                self.marks[marks] = found
        return found

    def word_ids(self, word: bytes) -> bytes:
        return self.ids(word.decode())

    def ends_in_letter(self, stem: bytes) -> bool:
        return stem[-1:].isalpha() and stem.isascii()

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(_MARKS)
        if stem != word and self.ends_in_letter(stem):
            found = self[stem] + self.mark(word[len(stem) :])
        else:
            found = self.word_ids(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found

    def encode(self, text: bytes) -> bytes:
        raise NotImplementedError


class WordEnds(_Cache):
    """Tokenizers that drop white space: the ids of a text are those of its words."""

    def __missing__(self, word: bytes) -> bytes:
        if word.isascii() and (small := word.lower()) != word:
            return self[small]
        return super().__missing__(word)

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


class _Unusual(Exception):
    """White space that does not part words."""


#: Bytes as byte-level tokenizers spell them: printable ones as themselves, others from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SPELLING = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


def _merges_only(library) -> bool:
    """Whether the ids of a word of letters, spelt byte by byte, are those of the library's merges alone."""
    told = json.loads(library.to_str())
    split, model = told["pre_tokenizer"] or {}, told["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    merges = model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    return bool(plain and merges and not told["normalizer"] and not any(_LETTERS.fullmatch(t["content"].strip()) for t in told["added_tokens"]))


class ByteLevel(_Cache):
    """Byte-level tokenizers that keep a space with the word after it.

    A text without unusual white space is cut before each single space or newline. Any other
    text (runs of white space, at either end, or white space under some definition only) is cut
    only where a black character is followed by plain white space. Unusual white space leaves
    an empty word or an odd one, which is never kept, so it shows when the word is looked up.
    Words of letters alone are one piece and go to the library's merges at once.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.model = self.library.model if _merges_only(self.library) else None

    def _merged(self, letters: bytes, before: str) -> bytes:
        spelt = before + letters.decode("latin-1").translate(_SPELLING)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])

    def word_ids(self, word: bytes) -> bytes:
        text = word.decode()
        if _LETTERS.fullmatch(text, 1 if text[0] == "\n" else 0) and self.model is not None:
            return self.mark(b"\n") + self._merged(word[1:], "") if text[0] == "\n" else self._merged(word, "Ġ")
        return self.ids(text if text[0] == "\n" else " " + text)

    def ends_in_letter(self, stem: bytes) -> bool:
        return _LETTERS.fullmatch(stem.decode()[-1:]) is not None

    def __missing__(self, word: bytes) -> bytes:
        if word in (b"", b"\n") or _ODD.search(word.decode()):
            raise _Unusual
        return super().__missing__(word)

    def encode(self, text: bytes) -> bytes:
        if not text:
            return b""
        head, *rest = text.replace(b"\n", b" \n").split(b" ")
        try:
            if not head or _ODD.search(start := head.decode()):
                raise _Unusual
            return self.ids(start) + b"".join(map(self.__getitem__, rest))
        except _Unusual:
            return b"".join(map(self.ids, _PIECES.findall(text.decode())))


_open: dict[tuple[type, str], _Cache] = {}


def encoder(kind: type[_Cache], path: str) -> _Cache:
    """One cache for each file and Python worker, until a stage of another kind runs there."""
    if (kind, path) not in _open:
        _open[kind, path] = kind(path)
        kept_by_worker.append(_open.clear)
    return _open[kind, path]
