"""Packing documents into sequences of at most ``window`` tokens, in their order.

Each task packs the documents of its own input partition as they come: their ids, each with
an end id, form one stream, and a sequence is a window of it. Where windows end is chosen by
dynamic programming over the ends of documents and sentences:

    cost(j) = min over i of cost(i) + padding(j - i) + penalty(j)

with no penalty at the end of a document, a small one at the end of a sentence, and a larger
one inside a sentence (such points are only offered in sentences that are long against the
window). Padding is ``window - length``, and none where the length is a power of two. The
minimum over all ``i`` within reach of ``j`` comes from a monotone queue; the few ``i`` at a
power of two before ``j`` are compared besides. The plan is settled in blocks of about a
million tokens, each handing its last windows on to the next, so memory is bounded.

Nothing is shuffled: a hot source or a group of copies is packed where it is read. Sequence
numbers hold the partition in their upper bits, so a task that is run again gives the same
ones.

Null and empty texts are documents of the end id alone. Equal rows are packed one by one,
null document ids stay null. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import pretokens, shared, texts

WINDOW = 2048
END_ID = 1
#: Cost, in tokens of padding, of a window that ends at a sentence's end or inside a sentence.
SENTENCE_PENALTY, INNER_PENALTY = 2.0, 24.0
#: Shorter windows are not made just because they need no padding.
LEAST = 128
#: Bytes of whole rows that are split into words at once, and words that a worker's table holds.
ROWS_BYTES, TABLE_WORDS = 1 << 20, 400_000
#: Tokens that are planned at once; windows of a block that the next one plans again.
BLOCK, HANDED_ON = 1 << 20, 4

PIECES = (
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
)


def byte_characters() -> dict[int, str]:
    """The characters by which byte-level vocabularies name bytes: itself if it prints, else one from 256 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def loaded(path: str) -> pretokens.WordIds:
    """Word table of a tokenizer file."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    kind = json.loads(tokenizer.to_str())
    if (kind["pre_tokenizer"] or {}).get("type") != "ByteLevel" or kind["normalizer"]:
        raise ValueError(f"{path}: a byte-level tokenizer without a normalizer is needed")
    tokenize, table = tokenizer.model.tokenize, byte_characters()

    def encode(words: list[bytes]) -> list[list[int]]:
        return [[t.id for t in tokenize(w.decode("latin-1").translate(table))] for w in words]

    return pretokens.WordIds(encode, TABLE_WORDS)


def word_table(path: str) -> pretokens.WordIds:
    """:func:`loaded`, kept by the worker until another stage's table takes its place."""
    return shared.one_table(("words", path), lambda: loaded(path))


@lru_cache(2)
def added_tokens(path: str) -> tuple[re.Pattern[bytes] | None, dict[bytes, int]]:
    """Pattern and ids of the tokens that a tokenizer file adds to its model, which are found before words are."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens must stand for their own text alone")
    ids = {t["content"].encode(): t["id"] for t in added if t["content"]}
    # the leftmost, and of those the longest
    by_size = sorted(ids, key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, by_size))) if ids else None, ids


def plan(ends: np.ndarray, penalties: np.ndarray, window: int, least: int = LEAST) -> list[int]:
    """Which of ``ends`` (rising, over 0, steps of at most ``window``) windows end at; the last always.

    Windows start at 0. The sum of padding and penalties of the chosen ends is least. Lengths of
    a power of two count as full from ``least`` on, so no crumbs are made on purpose.
    """
    points = np.concatenate([[0], ends])
    number = np.full(int(points[-1]) + 1, -1, np.int32)
    number[points] = np.arange(len(points))
    pairs: dict[int, list[int]] = {}
    for size in (1 << k for k in range(window.bit_length()) if least <= 1 << k < window):
        back = number[np.maximum(points - size, 0)]
        hit = np.flatnonzero((points >= size) & (back >= 0))
        for j, i in zip(hit.tolist(), back[hit].tolist()):
            pairs.setdefault(j, []).append(i)
    at, penalty = points.tolist(), [0.0, *penalties.tolist()]
    cost, came = [0.0] * len(at), [0] * len(at)
    # cost + position of the starts within reach, rising from the left; the least stands first
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, 0)])
    for j in range(1, len(at)):
        here = at[j]
        far = here - window
        while queue[0][1] < far:
            queue.popleft()
        least, _, i = queue[0]
        best = least + window - here
        if j in pairs:
            for k in pairs[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        cost[j] = best = best + penalty[j]
        came[j] = i
        value = best + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, here, j))
    chosen, j = [], len(at) - 1
    while j > 0:
        chosen.append(j - 1)
        j = came[j]
    return chosen[::-1]


def sentence_starts(raw: bytes, begin: np.ndarray) -> np.ndarray:
    """Numbers of the words (first bytes ``begin``) before which a sentence or line has ended."""
    data = np.frombuffer(raw, np.uint8)
    here = begin[1:]
    space = (data[here] == 0x20) | (data[here] == 0x0A)
    before = data[here - 1]
    stop = (before == 0x2E) | (before == 0x21) | (before == 0x3F)
    return np.flatnonzero((space & stop) | (before == 0x0A)) + 1


class Packer:
    """Takes documents in order, gives back rows of finished pieces."""

    def __init__(self, window: int, sentence: float, inner: float, block: int, sequence: int):
        self.window, self.sentence, self.inner, self.block, self.sequence = window, sentence, inner, block, sequence
        self.tokens: list[np.ndarray] = []
        self.held = 0  # tokens in hand
        self.ends: list[np.ndarray] = []
        self.penalties: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, first token (may lie before those in hand), tokens

    def add(self, doc_id: int | None, parts: list[np.ndarray], breaks: np.ndarray) -> Iterator[list]:
        """``breaks``: tokens of this document before each sentence but the first."""
        ids = np.concatenate([*parts, [END_ID]]).astype("<u4")
        n, window = len(ids), self.window
        breaks = np.unique(breaks[(breaks > 0) & (breaks < n)])
        cuts, penalties = np.append(breaks, n), np.full(len(breaks) + 1, self.sentence)
        penalties[-1] = 0.0
        gaps = np.diff(cuts, prepend=0)
        if (gaps > window // 4).any():
            step = max(1, window // 8)
            extra = np.concatenate([np.arange(c - g + step, c, step) for c, g in zip(cuts, gaps) if g > window // 4])
            cuts = np.concatenate([cuts, extra])
            penalties = np.concatenate([penalties, np.full(len(extra), self.inner)])
            order = np.argsort(cuts, kind="stable")
            cuts, penalties = cuts[order], penalties[order]
        self.docs.append((doc_id, self.held, n))
        self.tokens.append(ids)
        self.ends.append(cuts + self.held)
        self.penalties.append(penalties)
        self.held += n
        if self.held >= self.block:
            yield from self.settle(last=False)

    def settle(self, last: bool) -> Iterator[list]:
        """Rows of the planned windows; the last few stay in hand unless this is the end."""
        if not self.held:
            return
        ends, penalties = np.concatenate(self.ends), np.concatenate(self.penalties)
        chosen = plan(ends, penalties, self.window)
        if not last:
            if len(chosen) <= HANDED_ON:
                self.ends, self.penalties = [ends], [penalties]
                return
            chosen = chosen[:-HANDED_ON]
        bounds = ends[chosen]
        stop = int(bounds[-1])
        tokens = np.concatenate(self.tokens)
        first = np.array([d[1] for d in self.docs], np.int64)
        cuts = np.unique(np.concatenate([[0], bounds, first[(first > 0) & (first < stop)]]))
        left, right = cuts[:-1], cuts[1:]
        doc = np.searchsorted(first, left, "right") - 1
        window = np.searchsorted(bounds, left, "right")
        opened = np.concatenate([[0], bounds])[window]
        sizes = np.array([d[2] for d in self.docs], np.int64)
        view = memoryview(tokens).cast("B")
        sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(left.tolist(), right.tolist())]
        yield [
            [self.docs[k][0] for k in doc.tolist()],
            left - first[doc],
            right - left,
            np.array(sums, np.int64),
            sizes[doc],
            self.sequence + window,
            left - opened,
        ]
        self.sequence += len(bounds)
        rest = ends > stop
        self.ends, self.penalties = [ends[rest] - stop], [penalties[rest]]
        self.tokens, self.held = [tokens[stop:].copy()], self.held - stop
        self.docs = [(i, a - stop, n) for i, a, n in self.docs if a + n > stop]


def pack(
    df: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    sentence_penalty: float = SENTENCE_PENALTY,
    inner_penalty: float = INNER_PENALTY,
    block: int = BLOCK,
    added: bool = False,
) -> DataFrame:
    """One row for each part of a document in a sequence.

    With ``added``, text that spells one of the file's added tokens gets that token's id, as the
    tokenizer of the file gives it; otherwise it is text like any other.

    ``start`` (its document's ids before it), ``length``, ``ids_crc32`` (unsigned, of the ids as
    little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    kind = df.schema[doc_id].dataType
    schema = T.StructType([T.StructField(doc_id, kind), *(T.StructField(n, T.LongType()) for n, _ in PIECES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_table(path)
        special = added_tokens(path) if added else (None, {})
        packer = Packer(window, sentence_penalty, inner_penalty, block, TaskContext.get().partitionId() << 40)
        id_type = pa.int64()

        def rows(found: Iterator[list]) -> Iterator[pa.RecordBatch]:
            for ids, *columns in found:
                arrays = [pa.array(ids, id_type), *(pa.array(c, t) for c, (_, t) in zip(columns, PIECES))]
                yield pa.RecordBatch.from_arrays(arrays, names=[doc_id, *(n for n, _ in PIECES)])

        for batch in batches:
            id_type = batch.schema.field(doc_id).type
            names = batch.column(doc_id).to_pylist()
            for i, parts, breaks in _tokens(batch, text, words, *special):
                yield from rows(packer.add(names[i], parts, breaks))
        yield from rows(packer.settle(last=True))

    return texts.narrow(df, doc_id, text).mapInArrow(run, schema)


def _tokens(
    batch: pa.RecordBatch, text: str, words: pretokens.WordIds, added: re.Pattern[bytes] | None, added_ids: dict[bytes, int]
) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Row, ids, and ids before each sentence, of every text of a batch."""
    raw, offsets = texts.buffers(batch.column(text))
    for a, b in texts.row_slices(offsets, ROWS_BYTES):
        parts: list[list[np.ndarray]] = [[] for _ in range(b - a)]
        breaks: list[list[np.ndarray]] = [[] for _ in range(b - a)]
        size = [0] * (b - a)
        whole = raw[offsets[a] : offsets[b]].tobytes()
        bounds, row_of, token = offsets[a : b + 1] - offsets[a], range(b - a), None
        if added and added.search(whole):
            bounds, row_of, token = _segments(whole, bounds, added, added_ids)
        for piece, cuts, owner in pretokens.pieces(whole, bounds, texts.SLICE_BYTES):
            ids, begin, before = words.of(piece, cuts)
            at = before[np.searchsorted(begin, cuts)]
            ended = before[sentence_starts(piece, begin)] if len(begin) else at[:0]
            split = np.searchsorted(ended, at).tolist()
            at = at.tolist()
            for k, segment in enumerate(owner.tolist()):
                row = row_of[segment]
                found, stops = ids[at[k] : at[k + 1]], ended[split[k] : split[k + 1]] - at[k]
                if token and token[segment] is not None:
                    found, stops = np.array([token[segment]], ids.dtype), stops[stops == 0]
                parts[row].append(found)
                breaks[row].append(stops + size[row])
                size[row] += len(found)
        for row in range(b - a):
            yield a + row, parts[row], np.concatenate([np.zeros(0, np.int64), *breaks[row]])


def _segments(
    raw: bytes, offsets: np.ndarray, added: re.Pattern[bytes], added_ids: dict[bytes, int]
) -> tuple[np.ndarray, list[int], list[int | None]]:
    """Texts divided at added tokens: bounds, and each segment's text and id (``None`` if it is text)."""
    bounds, row_of, token = [0], [], []
    for row, (at, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for match in added.finditer(raw, at, end):
            bounds += [match.start(), match.end()]
            row_of += [row, row]
            token += [None, added_ids[match[0]]]
        bounds.append(end)
        row_of.append(row)
        token.append(None)
    return np.array(bounds, np.int64), row_of, token
