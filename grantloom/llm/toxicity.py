"""Toxicity by compression distance: how much better toxic text explains a window than ordinary text.

Two zstandard dictionaries are trained on labelled documents. The ordinary one comes from
ordinary text. Toxic documents are mostly ordinary text too, so the toxic one comes from those
of their words that open with a segment (``SEGMENT`` bytes) far more frequent in toxic than in
ordinary documents, judged by how many different words they follow; copies of one document add
nothing. The toxic dictionary stands in front of the ordinary one, so that the two differ in
what only toxic text has.

Texts are compared window by window. A window is one word between two halves of a fixed frame
that both dictionaries hold: the frame costs the same few bytes each time, and keeps the coder
from storing a short window as it is. A window counts where the toxic dictionary saves at
least ``SAVED`` bytes; a text's share of such bytes per word is held against a limit that is
calibrated on labelled documents which the dictionaries have not seen. Different windows are
compressed once per Python worker.

Learning uses at most ``TOXIC`` + ``ORDINARY`` labelled documents of at most ``LONGEST``
characters, picked by a hash of their id, and only those of the learning folds. Scoring reads
whole texts. Null and empty texts have the score 0; null ids are not held out and never
learned from; repeated rows get equal scores. Without labels of both kinds all scores are 0.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts

#: Most labelled documents learned from, and the longest of them in characters.
TOXIC, ORDINARY, LONGEST = 1500, 4500, 20_000
FOLDS, HELD_OUT = 5, 0
SEGMENT, LEVEL, SAVED = 5, 6, 4
ORDINARY_BYTES, TOXIC_BYTES, FRAME_BYTES = 2048, 8192, 48
#: Fewest different contexts of a segment, its least ratio of frequencies and likelihood gain.
CONTEXTS, RATIO, GAIN = 4, 10.0, 15.0
#: Windows that a worker remembers.
MEMORY = 600_000


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    frame: bytes
    limit: float

    @property
    def name(self) -> str:
        return hashlib.sha256(b"\0".join([self.toxic, self.ordinary, self.frame])).hexdigest()


class Windows:
    """Bytes that the toxic dictionary saves on single words."""

    def __init__(self, model: Model):
        half = len(model.frame) // 2
        self.left, self.right = model.frame[:half] + b" ", b" " + model.frame[half:]
        self.coders = []
        for content in (model.ordinary + model.frame, model.toxic + model.ordinary + model.frame):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        self.known: dict[bytes, int] = {}

    def _sizes(self, coder: zstandard.ZstdCompressor, windows: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, windows), "<u8", len(windows))
        spans = np.stack([np.cumsum(sizes) - sizes, sizes], axis=1).astype("<u8")
        done = coder.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(windows), spans.tobytes()), threads=0)
        return np.fromiter((len(done[i]) for i in range(len(done))), np.int64, len(windows))

    def saved(self, words: list[bytes]) -> np.ndarray:
        """Bytes saved on each word, what is below the threshold as 0."""
        new = list(set(words).difference(self.known))
        if new:
            if len(self.known) + len(new) > MEMORY:
                self.known.clear()
                new = list(set(words))
            for a in range(0, len(new), 20_000):
                some = new[a : a + 20_000]
                windows = [self.left + w + self.right for w in some]
                gain = self._sizes(self.coders[0], windows) - self._sizes(self.coders[1], windows)
                self.known.update(zip(some, np.maximum(gain - SAVED + 1, 0).tolist()))
        return np.array(list(map(self.known.__getitem__, words)), np.int64)

    def shares(self, rows: list[bytes]) -> list[float]:
        """Saved bytes per word of each text."""
        words = [r.split() for r in rows]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        sums = np.concatenate([[0], np.cumsum(self.saved([w for ws in words for w in ws]))])
        return ((sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)).tolist()


def windows_of(model: Model) -> Windows:
    """The coders of a model, kept by the worker until another stage's table takes its place."""
    return shared.one_table(("windows", model.name), lambda: Windows(model))


def score(share: float, limit: float) -> float:
    """0 to 1; one half at the limit."""
    return share / (share + limit) if share > 0 else 0.0


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, int]]:
    """``(text, toxic)`` of the bounded learning sample, each id once, in a fixed order."""
    marked = (
        labels.filter("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    picked = marked.filter("toxic = 1").orderBy(*order).limit(TOXIC).unionByName(marked.filter("toxic = 0").orderBy(*order).limit(ORDINARY))
    read = texts.narrow(docs, doc_id, text).toDF("doc_id", "text").filter(F.length("text").between(1, LONGEST))
    rows = read.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    return [(r[1], r[2]) for r in sorted(rows.collect(), key=lambda r: r[0])]


def _segments(rows: list[bytes]) -> tuple[Counter, int]:
    """Different contexts (the word before) of each opening segment, and the number of words."""
    seen, n = set(), 0
    for row in rows:
        before = b""
        words = row.lower().split()
        n += len(words)
        for word in words:
            seen.add(((b" " + word + b" ")[:SEGMENT], before))
            before = word
    return Counter(segment for segment, _ in seen), n


def fit(rows: list[tuple[str, int]]) -> Model:
    """Dictionaries from three quarters of the sample, the limit from the rest."""
    toxic = list(dict.fromkeys(t.encode() for t, y in rows if y))
    ordinary = list(dict.fromkeys(t.encode() for t, y in rows if not y))
    if not toxic or not ordinary:
        return Model(b"", b"", b"", math.inf)
    part = lambda x, own: [t for i, t in enumerate(x) if (i % 4 == 3) != own] or x
    learned_toxic, learned_ordinary = part(toxic, True), part(ordinary, True)
    (in_toxic, n_toxic), (in_ordinary, n_ordinary) = _segments(learned_toxic), _segments(learned_ordinary)
    marked = set()
    for segment, n in in_toxic.items():
        m = in_ordinary.get(segment, 0)
        ratio = n / max(n_toxic, 1) / ((m + 0.5) / max(n_ordinary, 1))
        expected = (n + m) * n_toxic / (n_toxic + n_ordinary)
        gain = 2 * (n * math.log(n / expected) + (m * math.log(m / (n + m - expected)) if m else 0.0))
        if n >= CONTEXTS and ratio > RATIO and gain > GAIN:
            marked.add(segment)
    words = Counter()
    for row in learned_toxic:
        words.update(w for w in row.split() if (b" " + w.lower() + b" ")[:SEGMENT] in marked)
    plain = [w for row in learned_ordinary for w in _pieces(row)]
    model = Model(
        _train(TOXIC_BYTES, [b" " + w + b" " for w, n in words.most_common() for _ in range(min(n, 20))]),
        _train(ORDINARY_BYTES, plain[:40_000]),
        b" ".join(max(learned_ordinary, key=lambda r: (len(r), r)).split())[:FRAME_BYTES],
        math.inf,
    )
    windows = Windows(model)
    yes, no = (np.sort(windows.shares(part(x, False))) for x in (toxic, ordinary))
    return Model(model.toxic, model.ordinary, model.frame, _limit(yes, no))


def _pieces(row: bytes, size: int = 64) -> list[bytes]:
    joined = b" ".join(row.split())
    return [joined[a : a + size] for a in range(0, len(joined), size)]


def _train(size: int, samples: list[bytes]) -> bytes:
    """Content of a trained dictionary; the different samples themselves where they all fit."""
    distinct = b"".join(dict.fromkeys(samples))
    if len(distinct) <= size:
        return distinct
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return distinct[:size]


def _limit(yes: np.ndarray, no: np.ndarray) -> float:
    """The share that parts toxic from ordinary texts with the fewest errors, kinds weighing alike."""
    shares = np.unique(np.concatenate([yes, no, [0.0]]))
    cuts = np.append((shares[:-1] + shares[1:]) / 2, shares[-1] + 1e-6)
    missed = np.searchsorted(yes, cuts) / max(len(yes), 1)
    wrong = 1 - np.searchsorted(no, cuts) / max(len(no), 1)
    errors = missed + wrong
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(cuts[best[len(best) // 2]])


def with_score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> tuple[DataFrame, str]:
    """``df`` with the score of each whole text, and the name of that column."""
    name = texts.fresh(name, df.columns)

    def work(batches):
        windows = windows_of(model)
        for batch in batches:
            out: list[float] = []
            if model.limit == math.inf:
                out = [0.0] * batch.num_rows
            else:
                raw, offsets = texts.buffers(batch.column(text))
                view = memoryview(raw)
                for a, b in texts.row_slices(offsets):
                    at = offsets[a : b + 1].tolist()
                    rows = [bytes(view[i:j]) for i, j in zip(at[:-1], at[1:])]
                    out += [score(s, model.limit) for s in windows.shares(rows)]
            yield batch, [pa.array(out, pa.float64())]

    return texts.extend(df, T.StructType([T.StructField(name, T.DoubleType())]), work), name


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = fit(sample(docs, labels, doc_id, text))
    scored, name = with_score(texts.narrow(docs, doc_id, text).toDF("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(name).alias("score"),
        F.when(F.col(name) >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def clean_rows(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that are not toxic."""
    scored, name = with_score(df, fit(sample(df, labels, doc_id, text)), text)
    return scored.filter(F.col(f"`{name}`") < 0.5).drop(name)
