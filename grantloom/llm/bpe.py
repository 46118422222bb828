"""Byte-level BPE: ids of whole texts and back, exactly as the merges give them.

A word's bytes are read as Latin-1 characters, so that an Aho-Corasick automaton over the
vocabulary finds every token that ends at every byte. The encoder walks from the left, takes
the longest token, and steps back to shorter ones where two neighbours could not stand side
by side after all merges. Whether two tokens can is worked out once per pair. Each byte is
left for good after a bounded number of trials, so a word takes time in proportion to its
length; words are memoised as well.

Null text: empty. Empty text: no ids. Rows are kept one for one, repeated ones included, and
null ids stay null. Text of any length is handled in pieces that end where a word begins.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import pretokens, texts

_LAST = 1 << 30
#: Pairs remembered at once.
PAIRS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file of a public vocabulary: base64 token and rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Bpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        merged: set[int] = set()
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            left_right = self._divide(token, rank)
            if left_right is None:
                continue  # no merges make it: only as a whole word
            if len(token) > 1:
                self.parts[rank] = left_right
                self.merges[left_right] = rank
            automaton.add_word(token, (len(token), rank))
            merged.add(rank)
        automaton.make_automaton()
        self.automaton = automaton
        size = max(self.ranks.values()) + 1
        # by rank: the length of a token, and the longest other token that it begins with
        self.sizes, self.shorter = [0] * size, [-1] * size
        for token, rank in self.ranks.items():
            self.sizes[rank] = len(token)
            starts = (self.ranks.get(token[:k], -1) for k in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in starts if r in merged), -1)
        names: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            names[rank] = token
        self.names = ByteTable(names)
        self.decimals = ByteTable([b"%d " % i for i in range(size)])

    def _divide(self, token: str, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge is ``token``; itself for a single byte."""
        if len(token) == 1:
            return rank, rank
        ranks, spans = self.ranks, list(token)
        while len(spans) > 2:
            best, at = rank, -1
            for i in range(len(spans) - 1):
                r = ranks.get(spans[i] + spans[i + 1], _LAST)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            spans[at : at + 2] = [spans[at] + spans[at + 1]]
        return ranks[spans[0]], ranks[spans[1]]

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay side by side when their bytes are merged together.

        Merges are undone from the seam, the later one first. A token that spans the seam and
        would have come before the merges still standing there rules the pair out.
        """
        limit, parts, merges = _LAST, self.parts, self.merges
        while True:
            across = merges.get((left, right))
            if across is not None and across < limit:
                return False
            whole_left, whole_right = left not in parts, right not in parts
            if whole_left and whole_right:
                return True
            # equal ranks: the same token twice, of which the left one was merged first
            if whole_right or (not whole_left and left > right):
                limit, left = left, parts[left][1]
            else:
                limit, right = right + 1, parts[right][0]

    def word(self, word: str) -> Sequence[int]:
        """Ids of one word, given as Latin-1. A byte of a long word costs some ten bytes of memory."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        longest = array("i", [-1]) * n  # the longest token that starts at each byte
        for end, (size, token) in self.automaton.iter(word):
            longest[end + 1 - size] = token
        pairs, sizes, shorter = self.pairs, self.sizes, self.shorter
        starts, tokens = array("q"), array("i")
        dead = bytearray(n + 1)
        at, token, before = 0, longest[0], -1
        while True:
            while token >= 0:
                if not dead[at + sizes[token]]:
                    if before < 0:
                        break
                    fits = pairs.get((before, token))
                    if fits is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        fits = pairs[before, token] = self._fits(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                starts.append(at)
                tokens.append(token)
                at += sizes[token]
                if at == n:
                    return tokens
                before, token = token, longest[at]
            else:
                dead[at] = 1
                at, token = starts.pop(), shorter[tokens.pop()]
                before = tokens[-1] if tokens else -1

    def words(self, words: list[bytes]) -> list[Sequence[int]]:
        return [self.word(w.decode("latin-1")) for w in words]


class ByteTable:
    """Byte strings by number, put together for many numbers at once."""

    def __init__(self, items: list[bytes]):
        self.size = np.fromiter(map(len, items), np.int32, len(items))
        self.at = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.raw = np.frombuffer(b"".join(items), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and the position after each number's."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        index = np.repeat(self.at[ids] - (ends - sizes).astype(np.int32), sizes)
        index += np.arange(total, dtype=np.int32)
        return self.raw[index], ends


@lru_cache(2)
def loaded(path: str) -> tuple[Bpe, pretokens.WordIds]:
    """A vocabulary and its word table, once per Python worker."""
    bpe = Bpe(read_ranks(path))
    return bpe, pretokens.WordIds(bpe.words)


def encode_text(text: str, path: str) -> list[int]:
    raw = text.encode()
    _, words = loaded(path)
    out: list[int] = []
    for piece, offsets, _ in pretokens.pieces(raw, np.array([0, len(raw)]), texts.SLICE_BYTES):
        out += words.of(piece, offsets)[0].tolist()
    return out


def decode_ids(ids: list[int], path: str) -> bytes:
    return loaded(path)[0].names.join(np.array(ids, np.int64))[0].tobytes()


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text as an array column."""
    name = texts.fresh(ids, df.columns)

    def work(batches):
        for batch in batches:
            rows = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in _ids_by_row(batch, text, path)]
            values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32())
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            yield batch, [pa.ListArray.from_arrays(pa.array(ends), values)]

    return texts.extend(df, T.StructType([T.StructField(name, T.ArrayType(T.IntegerType()))]), work)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each row's ids stand for; null ids: null."""
    name = texts.fresh(text, df.columns)

    def work(batches):
        names = loaded(path)[0].names
        for batch in batches:
            rows = batch.column(ids).to_pylist()
            yield batch, [pa.array([None if r is None else names.join(np.array(r, np.int64))[0].tobytes() for r in rows], pa.binary())]

    return texts.extend(df, T.StructType([T.StructField(name, T.BinaryType())]), work)


def _ids_by_row(batch: pa.RecordBatch, text: str, path: str) -> Iterator[list[np.ndarray]]:
    _, words = loaded(path)
    raw, offsets = texts.buffers(batch.column(text))
    for a, b in texts.row_slices(offsets):
        rows: list[list[np.ndarray]] = [[] for _ in range(b - a)]
        part = raw[offsets[a] : offsets[b]].tobytes()
        for piece, cuts, owner in pretokens.pieces(part, offsets[a : b + 1] - offsets[a], texts.SLICE_BYTES):
            ids, begin, before = words.of(piece, cuts)
            at = before[np.searchsorted(begin, cuts)]
            for k, row in enumerate(owner.tolist()):
                rows[row].append(ids[at[k] : at[k + 1]])
        yield from rows


DIGEST = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Number of ids, digest of the ids in decimal, digest of the text decoded from them.

    The columns are ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; keep ``df`` free of these.
    """

    def work(batches):
        bpe, words = loaded(path)
        for batch in batches:
            raw, offsets = texts.buffers(batch.column(text))
            counts, shown, decoded = [], [], []
            for a, b in texts.row_slices(offsets):
                part = raw[offsets[a] : offsets[b]].tobytes()
                n = [0] * (b - a)
                sums = [(hashlib.sha256(), hashlib.sha256()) for _ in range(b - a)]
                for piece, cuts, owner in pretokens.pieces(part, offsets[a : b + 1] - offsets[a], texts.SLICE_BYTES):
                    ids, begin, before = words.of(piece, cuts)
                    at = before[np.searchsorted(begin, cuts)].tolist()
                    decimals, decimal_ends = bpe.decimals.join(ids)
                    back, back_ends = bpe.names.join(ids)
                    for k, row in enumerate(owner.tolist()):
                        i, j = at[k], at[k + 1]
                        if i == j:
                            continue
                        # one blank between ids: the last one of a text is held back
                        if n[row]:
                            sums[row][0].update(b" ")
                        sums[row][0].update(decimals[decimal_ends[i - 1] if i else 0 : decimal_ends[j - 1] - 1])
                        sums[row][1].update(back[back_ends[i - 1] if i else 0 : back_ends[j - 1]])
                        n[row] += j - i
                counts += n
                shown += [x.hexdigest() for x, _ in sums]
                decoded += [x.hexdigest() for _, x in sums]
            yield batch, [pa.array(counts, pa.int64()), pa.array(shown, pa.string()), pa.array(decoded, pa.string())]

    return texts.extend(df, DIGEST, work)
