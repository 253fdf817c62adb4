"""Suffix arrays of byte buffers by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as smaller or larger than the next one. The leftmost smaller ones are
sorted by their substrings, which are named, and the string of names is sorted in turn; the
other suffixes are then induced bucket by bucket: what a bucket holds puts the suffixes one byte
further left into their buckets, in order. A bucket is one array operation, so a pass is linear
and has no loop over suffixes. The string of names has too many letters for that and is sorted
by doubling ranks.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one integer; zeros beyond the end."""
    x = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    for k in (1, 2, 4):
        x[: len(x) - k] |= x[k:] << np.uint64(8 * k)
    return x[: len(text)]


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is not."""
    n = len(text)
    less = np.zeros(n, bool)
    less[:-1] = text[:-1] < text[1:]
    decides = np.ones(n, bool)
    decides[:-1] = text[:-1] != text[1:]
    at = np.where(decides, np.arange(n, dtype=np.int32), n)
    return less[np.minimum.accumulate(at[::-1])[::-1]]


def _deal(places: np.ndarray, text: np.ndarray, into: list[list[np.ndarray]]) -> None:
    """Append ``places``, in order, to the buckets of their bytes."""
    if not len(places):
        return
    byte = text[places]
    order = np.argsort(byte, kind="stable")
    places, byte = places[order], byte[order]
    cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
    for part, b in zip(np.split(places, cuts), byte[np.concatenate(([0], cuts))].tolist()):
        into[b].append(part)


def _before(places: np.ndarray) -> np.ndarray:
    out = places - 1
    return out[out >= 0]


def _bucket(held: list[np.ndarray], text: np.ndarray, byte: int) -> np.ndarray:
    """A bucket's suffixes of one kind: those put there, then rounds of those that repeat its byte."""
    if not held:
        return np.zeros(0, np.int32)
    parts = [np.concatenate(held)]
    while len(parts[-1]):
        left = _before(parts[-1])
        parts.append(left[text[left] == byte])
    return np.concatenate(parts)


def _induce(text: np.ndarray, least: np.ndarray) -> np.ndarray:
    """All suffixes, given the leftmost smaller ones in the order they have within their buckets."""
    starts: list[list[np.ndarray]] = [[] for _ in range(256)]
    _deal(least, text, starts)
    large: list[list[np.ndarray]] = [[] for _ in range(256)]
    small: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger = []
    large[text[-1]].append(np.array([len(text) - 1], np.int32))
    for byte in range(256):
        larger.append(_bucket(large[byte], text, byte))
        left = _before(np.concatenate([larger[-1], *starts[byte]]))
        _deal(left[text[left] > byte], text, large)
    out = []
    for byte in range(255, -1, -1):
        mine = _bucket(small[byte], text, byte)  # from the largest down
        left = _before(np.concatenate([mine, larger[byte][::-1]]))
        _deal(left[text[left] < byte], text, small)
        out += [mine, larger[byte][::-1]]
    return np.concatenate(out)[::-1]


def _equal(words: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from the places ``a`` and ``b`` are the same."""
    out = np.ones(len(a), bool)
    todo, done = np.arange(len(a)), 0
    while len(todo):
        left = np.minimum(length[todo] - done, 8).astype(np.uint64)
        mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left)
        same = ((words[a[todo] + done] ^ words[b[todo] + done]) & mask) == 0
        out[todo[~same]] = False
        done += 8
        todo = todo[same & (length[todo] > done)]
    return out


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a string of names, the last of which occurs once."""
    n = len(names)
    count = np.bincount(names)
    rank = (np.cumsum(count) - count)[names]
    active, step = np.flatnonzero(count[names] > 1), 1
    while len(active):
        # Tied suffixes agree on ``step`` names, none of which is the last: there is a place after them.
        key = rank[active] * (n + 1) + rank[active + step]
        order = np.argsort(key)
        active, key = active[order], key[order]
        old, index = rank[active], np.arange(len(active))
        group = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), index, 0))
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = old + np.maximum.accumulate(np.where(fresh, index, 0)) - group
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(active)))
        active = active[np.repeat(sizes, sizes) > 1]
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def suffix_array(text: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Places of all suffixes of a byte array in order; the end is smaller than any byte."""
    if len(text) < 2:
        return np.arange(len(text), dtype=np.int32)
    words = words_at(text) if words is None else words
    smaller = _smaller(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + np.int32(1)
    if len(leftmost) > 1:
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        order = _induce(text, leftmost)
        order = order[is_leftmost[order]]
        length = np.zeros(len(text), np.int64)
        length[leftmost[:-1]] = np.diff(leftmost) + 1  # up to and with the next leftmost one; 0 for the last
        a, b = order[:-1], order[1:]
        same = (length[a] == length[b]) & (length[a] > 0)
        same[same] = _equal(words, a[same], b[same], length[a[same]])
        name = np.zeros(len(text), np.int64)
        name[order] = np.concatenate(([0], np.cumsum(~same)))
        leftmost = leftmost[_sorted_names(name[leftmost])]
    return _induce(text, leftmost)


def common_prefixes(text: np.ndarray, order: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """For every place, the length of the prefix its suffix shares with the one before it in ``order``.

    In text order: where the bytes to the left agree, it is one less than that of the place to
    the left, so bytes are compared only at the other places.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    words = words_at(text) if words is None else words
    before = np.empty(n, np.int32)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    compared = np.ones(n, bool)
    inner = before[1:] > 0
    compared[1:][inner] = text[:-1][inner] != text[before[1:][inner] - 1]
    at = np.flatnonzero(compared)
    found = np.zeros(n, np.int64)
    todo = at[before[at] >= 0]
    done = 0
    while len(todo):
        other = before[todo].astype(np.int64)
        room = n - done - np.maximum(todo, other)  # bytes up to the end
        a, b = words[np.minimum(todo + done, n - 1)], words[np.minimum(other + done, n - 1)]
        differ = a ^ b
        lowest = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(lowest - np.uint64(1)) >> 3)
        equal = np.minimum(equal, np.maximum(room, 0))
        found[todo] += equal
        todo = todo[(equal == 8)]
        done += 8
    last = np.maximum.accumulate(np.where(compared, np.arange(n), 0))
    return found[last] + last - np.arange(n)
