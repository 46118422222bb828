"""Splitting text the way byte-level BPE vocabularies expect, a buffer at a time.

The public pattern of these vocabularies is

    's|'t|'re|'ve|'m|'ll|'d| ?letters+| ?numbers+| ?others+|white space

Every character belongs to exactly one match, so the matches are given by their starts. They
follow from the class of each character and its neighbours, which numpy finds for a whole
buffer of texts at once. Equal words of a buffer are then encoded once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
_APOSTROPHE, _BLANK = 0x27, 0x20
#: A piece of a long text may end before a blank that stands between these.
_CUT = regex.compile(rb"(?<=[A-Za-z0-9.,;:]) (?=[A-Za-z0-9])")


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of each code point, by the Unicode properties of the pattern."""
    table = np.full(0x110000, OTHER, np.uint8)
    # without the surrogates; by way of numpy, for a list of a million strings is a hundred times the table
    numbers = np.concatenate([np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4")])
    points = numbers.tobytes().decode("utf-32-le")
    for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
        for match in regex.finditer(name, points):
            table[ord(match[0][0]) : ord(match[0][-1]) + 1] = kind
    return table


def starts(raw: bytes, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a match begins, in texts laid end to end.

    ``offsets`` are the texts' first bytes and the end. A match never crosses into the next text.
    """
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = data if len(lead) == len(data) else np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    begins = offsets[:-1][np.diff(offsets) > 0]
    first[np.searchsorted(lead, begins)] = True
    first[n] = True

    begin = first[:n].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # of white space in front of other text the last character stands apart, and a blank joins what follows
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    begin |= last
    joins = last & (points == _BLANK)
    begin[1:] &= ~joins[:-1]

    for at in np.flatnonzero((points == _APOSTROPHE) & begin).tolist():
        rest = bytes(x if x < 128 else 0 for x in points[at + 1 : at + 3].tolist())
        size = 1 if rest[:1] in (b"s", b"t", b"m", b"d") else 2 if rest in (b"re", b"ve", b"ll") else 0
        if size and not first[at + 1 : at + 1 + size].any():
            begin[at + 1] = False
            if at + 1 + size < n:
                begin[at + 1 + size] = True
    return lead[np.flatnonzero(begin)]


def pieces(raw: bytes, offsets: np.ndarray, limit: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """``(bytes, offsets, text numbers)`` of at most about ``limit`` bytes each.

    Texts over the limit are divided in front of a blank between two words, where a match
    always begins, so the words of the parts are the words of the text.
    """
    cuts, owner = [0], []
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while b - a > limit:
            found = _CUT.search(raw, a + limit // 2, b)
            if not found:
                break
            a = found.start()
            cuts.append(a)
            owner.append(i)
        cuts.append(b)
        owner.append(i)
    cuts_, owner_ = np.array(cuts, np.int64), np.array(owner, np.int64)
    at = 0
    while at < len(owner_):
        stop = max(at + 1, int(np.searchsorted(cuts_, cuts_[at] + limit, "right")) - 1)
        stop = min(stop, len(owner_))
        yield raw[cuts_[at] : cuts_[stop]], cuts_[at : stop + 1] - cuts_[at], owner_[at:stop]
        at = stop


class WordIds:
    """Ids of words, each word encoded once while it stays in the table.

    ``encode`` turns a list of words into lists of ids. The table holds at most ``limit``
    words; it is emptied when full, which costs time and changes nothing else.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = 800_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.at = np.zeros(1 << 14, np.int32)
        self.size = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _add(self, words: list[bytes]) -> None:
        found = self.encode(words)
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        total, n = int(sizes.sum()), len(self.slots)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(words) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.ids[self.used : self.used + total] = np.fromiter((i for ids in found for i in ids), np.int32, total)
        self.at[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(words)] = sizes
        self.used += total
        self.slots.update(zip(words, range(n, n + len(words))))

    def of(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, first byte of each word, ids before each word)``, the last with the total at its end."""
        begin = starts(raw, offsets)
        if not len(begin):
            return np.zeros(0, np.int32), begin, np.zeros(1, np.int64)
        ends = np.append(begin, len(raw)).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        coded = column.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.slots) + len(words) > self.limit:
            self._clear()
        slots = [*map(self.slots.get, words)]
        if None in slots:
            self._add([w for w, s in zip(words, slots) if s is None])
            slots = [*map(self.slots.__getitem__, words)]
        slot = np.array(slots, np.int32)[coded.indices.to_numpy()]
        sizes = self.size[slot]
        before = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(sizes, out=before[1:])
        index = np.repeat(self.at[slot] - before[:-1].astype(np.int32), sizes)
        index += np.arange(before[-1], dtype=np.int32)
        return self.ids[index], begin, before
