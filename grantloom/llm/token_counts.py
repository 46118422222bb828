"""Tokens of each text by a sentencepiece BPE model, counted by pre-token and never as ids.

A merge can join two characters only if some piece of the vocabulary holds them side by side.
Text is therefore divided wherever the two neighbours stand together in no piece; what lies
between is a pre-token, and the pieces of a text are those of its pre-tokens. The blank that
the model puts in front of a text is put there first.

The work is three steps. Every pre-token that occurs is found once over all texts (one
aggregate) and its pieces are counted, by the library, once. The most frequent pre-tokens, at
most ``FREQUENT``, are handed to the tasks that read the texts (keys of at most ``KEY_BYTES``
bytes, so at most a few megabytes) and are summed there; that takes the hot keys out. They are
those above a level of occurrence, which a histogram of levels gives. The frequencies
of all other pre-tokens are joined to the counts by key and summed by row. None of these
makes up much more than one in ``FREQUENT`` of all occurrences, so the join has no hot key.

Null and empty texts have no tokens. Texts that spell special pieces are ordinary text, as the
library has it. Every row gets a result row, repeated rows and null ids too; an empty table
gives an empty result. Other columns play no part. The longest unit held is one row's text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts

#: Pre-tokens summed where the texts are read, and the longest that stand for themselves in a key.
FREQUENT, KEY_BYTES = 65_536, 32
#: Characters that one step looks at.
BLOCK = 1 << 20
_BLANK, _MARK = 0x20, 0x2581
#: Appended to a model: its normalizer adds no blank in front (a later field value overrides).
_NO_PREFIX = bytes([0x1A, 2, 0x18, 0])


class Pieces:
    """Where pre-tokens begin, and how many pieces one has."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.model = sentencepiece.SentencePieceProcessor(model_proto=file.read() + _NO_PREFIX)
        pairs = set()
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            pairs.update(zip(piece, piece[1:]))
        known = sorted({c for pair in pairs for c in pair})
        number = {c: n for n, c in enumerate(known, 1)}
        self.kind = np.zeros(0x110000, np.uint16)
        for c, n in number.items():
            self.kind[ord(c)] = n
        self.kind[_BLANK] = self.kind[_MARK]
        self.width = len(known) + 1
        self.joins = np.zeros(self.width * self.width, bool)
        for a, b in pairs:
            self.joins[number[a] * self.width + number[b]] = True

    def starts(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """First byte of every pre-token of texts laid end to end."""
        found, before = [], 0
        data = np.frombuffer(raw, np.uint8)
        for a in range(0, len(data), BLOCK):
            part = data[a : a + BLOCK + 3]
            lead = np.flatnonzero((part & 0xC0) != 0x80)
            lead = lead[lead < BLOCK]
            if not len(lead):
                continue
            stop = a + int(lead[-1]) + 1
            while stop < len(data) and data[stop] & 0xC0 == 0x80:
                stop += 1
            points = np.frombuffer(raw[a + int(lead[0]) : stop].decode().encode("utf-32-le"), np.uint32)
            kind = self.kind[points].astype(np.int64)
            pair = np.concatenate([[before], kind[:-1]]) * self.width + kind
            found.append(a + lead[~self.joins[pair]])
            before = int(kind[-1])
        first = offsets[:-1][np.diff(offsets) > 0]
        return np.union1d(np.concatenate(found), first) if found else np.zeros(0, np.int64)

    def words(self, raw: bytes, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pre-tokens, equal ones alike, and the first byte of each."""
        begin = self.starts(raw, offsets)
        ends = np.append(begin, len(raw)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return column.dictionary_encode(), begin

    def count(self, words: list[bytes]) -> list[int]:
        """Pieces of each pre-token."""
        return [len(ids) for ids in self.model.encode([w.decode() for w in words], num_threads=1)]


@lru_cache(1)
def loaded(path: str) -> Pieces:
    """The model, once per Python worker."""
    return Pieces(path)


def count_text(text: str, path: str) -> int:
    """Tokens of one text."""
    if not text:
        return 0
    raw = b" " + text.encode()
    words, _ = loaded(path).words(raw, np.array([0, len(raw)]))
    each = np.array(loaded(path).count(words.dictionary.to_pylist()))
    return int(each[words.indices.to_numpy()].sum())


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """As :func:`texts.documents`, a blank in front of each text that is not empty."""
    for a, b, raw, offsets in texts.documents(batch, text):
        at = offsets.tolist()
        rows = [b" " + raw[i:j] if j > i else b"" for i, j in zip(at[:-1], at[1:])]
        yield a, b, b"".join(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])


def _key(word):
    return F.when(F.length(word) <= KEY_BYTES, word).otherwise(F.unhex(F.sha2(word, 256)))


def vocabulary(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``key, n, pieces`` of every pre-token that occurs: how often, and its pieces."""

    def occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, raw, offsets in _slices(batch, text):
                words, _ = loaded(path).words(raw, offsets)
                times = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays([words.dictionary.cast(pa.binary()), pa.array(times.astype(np.int64))], names=["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = pa.array(loaded(path).count(batch.column("word").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], names=["word", "n", "pieces"])

    each = texts.narrow(df, text).mapInArrow(occurring, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return each.mapInArrow(counted, "word binary, n long, pieces long").select(_key(F.col("word")).alias("key"), "n", "pieces")


def _frequent(known: DataFrame, most: int) -> dict[bytes, int]:
    """Pieces of the pre-tokens above the lowest level of occurrence (eighths of a doubling) that leaves at most ``most``."""
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = known.groupBy(level.alias("level")).count().collect()  # at most 512 levels
    least, held = None, 0
    for size in sorted(sizes, reverse=True):
        held += size["count"]
        if held > most:
            break
        least = size.level
    if least is None:
        return {}
    return {bytes(r.key): r.pieces for r in known.filter(level >= least).select("key", "pieces").collect()}


def counts(df: DataFrame, path: str, limit: int, doc_id: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    spark = df.sparkSession
    docs = texts.narrow(df, doc_id, text).toDF("doc_id", "text")
    known = shared.keep(vocabulary(docs, path))
    hot = spark.sparkContext.broadcast(_frequent(known, frequent))
    fields = [("key", T.BinaryType()), ("row", T.LongType()), ("n", T.LongType())]
    fields += [("doc_id", docs.schema["doc_id"].dataType), ("n_bytes", T.LongType()), ("tokens", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A line for each row, with what it has of frequent pre-tokens, and one for each other pre-token of a row."""
        row, table = TaskContext.get().partitionId() << 40, hot.value
        for batch in batches:
            for a, b, raw, offsets in _slices(batch, "text"):
                words, begin = loaded(path).words(raw, offsets)
                distinct, code = words.dictionary.to_pylist(), words.indices.to_numpy()
                each = np.array([table.get(w if len(w) <= KEY_BYTES else b"", -1) for w in distinct], np.int64)
                owner = np.searchsorted(offsets, begin, "right") - 1
                here = each[code] if len(code) else np.zeros(0, np.int64)
                tokens = np.bincount(owner, np.maximum(here, 0), b - a).astype(np.int64)
                rows = np.arange(row, row + b - a)
                sizes = np.diff(offsets)
                # no key of a pre-token begins with this byte or has this length
                own = [b"\xff" + int(r).to_bytes(8, "big") for r in rows]
                none = pa.nulls(b - a, pa.int64())
                found = [pa.array(own, pa.binary()), pa.array(rows), none, batch.column("doc_id").slice(a, b - a)]
                yield pa.RecordBatch.from_arrays([*found, pa.array(sizes - (sizes > 0)), pa.array(tokens)], names=schema.names)

                rare = np.flatnonzero(here < 0)
                if len(rare):
                    pair, n = np.unique(owner[rare] * len(distinct) + code[rare], return_counts=True)
                    who, word = np.divmod(pair, len(distinct))
                    keys = pa.array([_digest(distinct[w]) for w in word.tolist()], pa.binary())
                    empty = [pa.nulls(len(n), f.type) for f in (batch.schema.field("doc_id"), none, none)]
                    yield pa.RecordBatch.from_arrays([keys, pa.array(rows[who]), pa.array(n.astype(np.int64)), *empty], names=schema.names)
                row += b - a

    parts = docs.mapInArrow(summed, schema).join(known.select("key", "pieces"), "key", "left")
    found = parts.groupBy("row").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.coalesce(F.col("n") * F.col("pieces"), "tokens")).alias("n_tokens"),
    )
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _digest(word: bytes) -> bytes:
    """The key of a pre-token, as :func:`_key` has it."""
    return word if len(word) <= KEY_BYTES else hashlib.sha256(word).digest()
