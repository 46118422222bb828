"""Language identification with a byte convolutional network, trained here in numpy.

The network reads windows of ``WINDOW`` bytes. Filters of several widths slide over one-hot
bytes; a filter is thus a table of weights by offset and byte, and its answer at a place is the
sum of a few looked-up numbers. Each filter keeps its largest answer in the window, and a
softmax layer turns these into languages. A text is cut into windows from end to end, and its
languages' log chances are added up over all of them.

Learning uses at most ``PER_LANGUAGE`` documents of each of at most ``LANGUAGES`` languages,
picked by a hash of their id from the learning folds, and of each at most ``LONGEST``
characters long. Prediction reads whole texts. Null texts and texts without a letter are
``und`` with score 0. Null ids are not held out and never learned from. Repeated rows get equal
results. Without labelled text everything is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import texts

#: Bounds of the learning sample: documents of a language, languages, characters of a document.
PER_LANGUAGE, LANGUAGES, LONGEST = 400, 200, 20_000
FOLDS, HELD_OUT = 4, 2
WINDOW, WIDTHS, FILTERS = 192, (2, 3, 4), 12
EPOCHS, BATCH, RATE, WINDOWS_PER_TEXT = 6, 64, 0.02, 6
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Bytes of windows that a task works on at once.
_AT_ONCE = 1 << 18


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: offset, byte, filter
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def new(languages: list[str], seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = len(WIDTHS) * FILTERS
        return Network(
            languages, tables, np.zeros(n, np.float32),
            rng.normal(0, 0.1, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32),
        )

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Largest answer of each filter in each window, and its place if asked for."""
        values, places = [], []
        for table in self.tables:
            width = len(table)
            n = windows.shape[1] - width + 1
            answer = table[0][windows[:, :n]]
            for o in range(1, width):
                answer += table[o][windows[:, o : o + n]]
            if where:
                place = answer.argmax(axis=1)
                places.append(place)
                values.append(np.take_along_axis(answer, place[:, None, :], 1)[:, 0])
            else:
                values.append(answer.max(axis=1))
        return np.maximum(np.concatenate(values, axis=1) + self.bias, 0), places

    def log_chances(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows)[0] @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def step(self, windows: np.ndarray, labels: np.ndarray, state: dict, rate: float) -> None:
        """One step down the gradient of the cross-entropy, scaled by running squares (Adagrad)."""
        pooled, places = self.pooled(windows, where=True)
        z = pooled @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(len(labels)), labels] -= 1
        z /= len(labels)
        back = (z @ self.out.T) * (pooled > 0)
        grads = [("out", self.out, pooled.T @ z), ("out_bias", self.out_bias, z.sum(0)), ("bias", self.bias, back.sum(0))]
        columns = np.arange(FILTERS)[None, :]
        for k, (table, place) in enumerate(zip(self.tables, places)):
            grad = np.zeros_like(table)
            part = back[:, k * FILTERS : (k + 1) * FILTERS]
            for o in range(len(table)):
                # only the place that won in a window passes anything back
                bytes_there = np.take_along_axis(windows, place + o, 1)
                np.add.at(grad[o], (bytes_there, np.broadcast_to(columns, bytes_there.shape)), part)
            grads.append((f"table{k}", table, grad))
        for name, weight, grad in grads:
            seen = state.setdefault(name, np.full_like(weight, 1e-6))
            seen += grad**2
            weight -= rate * grad / np.sqrt(seen)


def windows_of(text: bytes, window: int = WINDOW) -> np.ndarray:
    """A text in windows from end to end; the last is filled up with blanks."""
    n = max(1, -(-len(text) // window))
    return np.frombuffer(text.ljust(n * window), np.uint8).reshape(n, window)


def train(rows: list[tuple[str, str]], seed: int = 7) -> Network | None:
    """A network from ``(text, language)`` rows; None without any."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    windows, labels = [], []
    for text, lang in rows:
        cut = windows_of(text.encode())
        cut = cut[rng.permutation(len(cut))[:WINDOWS_PER_TEXT]]
        windows.append(cut)
        labels += [number[lang]] * len(cut)
    x, y = np.concatenate(windows), np.array(labels)
    # short texts must be told apart too: a share of windows keeps only its first bytes
    short = rng.random(len(x)) < 0.3
    keep = rng.integers(24, WINDOW, len(x))
    x = np.where(short[:, None] & (np.arange(WINDOW)[None, :] >= keep[:, None]), 0x20, x).astype(np.uint8)
    network, state = Network.new(languages, seed), {}
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(x), BATCH):
            some = order[a : a + BATCH]
            network.step(x[some], y[some], state, RATE / (1 + epoch / 2))
    return network


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """``(text, language)`` of the bounded learning sample, in a fixed order.

    Which documents it holds is settled on ids and languages alone, reduced in each task.
    """
    narrow = texts.narrow(docs, doc_id, text, lang).toDF("doc_id", "text", "lang")
    usable = narrow.filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.length("text").between(20, LONGEST) & ~held_out(F.col("doc_id"))
    )
    common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    # a hash range that holds about twice the wanted number of each language, never a whole language in one task
    share = F.least(F.lit(1.0), F.lit(2.0 * PER_LANGUAGE) / F.col("count"))
    ticket = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    near = usable.join(F.broadcast(common), "lang").filter(ticket <= share).select("lang", "doc_id").distinct()
    ids = near.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(F.xxhash64("doc_id"), "doc_id"))).alias("ids"))
    picked = ids.select("lang", F.explode(F.slice("ids", 1, PER_LANGUAGE)).alias("x")).select("lang", "x.doc_id")
    rows = usable.join(F.broadcast(picked), ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    return [(r[2], r[0]) for r in sorted(rows.collect(), key=lambda r: (r[0], r[1]))]


def predict_texts(network: Network | None, rows: list[bytes]) -> list[tuple[str, float]]:
    """Language and its share of the chances, for each text."""
    out = [(UNKNOWN, 0.0)] * len(rows)
    if network is None:
        return out
    real = [i for i, r in enumerate(rows) if _LETTER.search(r.decode(errors="replace"))]
    cuts = [windows_of(rows[i]) for i in real]
    if not cuts:
        return out
    x = np.concatenate(cuts)
    size = max(1, _AT_ONCE // WINDOW)
    chances = np.concatenate([network.log_chances(x[a : a + size]) for a in range(0, len(x), size)])
    sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
    sums = np.add.reduceat(chances, np.cumsum(sizes) - sizes, axis=0)
    mean = sums / sizes[:, None]
    best = mean.argmax(axis=1)
    shares = np.exp(mean - mean.max(axis=1, keepdims=True))
    shares = (1.0 / shares.sum(axis=1)).clip(0.0, 1.0)
    for k, i in enumerate(real):
        out[i] = (network.languages[best[k]], float(shares[k]))
    return out


def with_language(df: DataFrame, network: Network | None, text: str = "text", name: str = "lang_pred", score: str = "score"):
    """``df`` with the predicted language of each whole text and its score, and their names."""
    name = texts.fresh(name, df.columns)
    score = texts.fresh(score, [*df.columns, name])

    def work(batches):
        for batch in batches:
            found: list[tuple[str, float]] = []
            raw, offsets = texts.buffers(batch.column(text))
            view = memoryview(raw)
            for a, b in texts.row_slices(offsets):
                at = offsets[a : b + 1].tolist()
                found += predict_texts(network, [bytes(view[i:j]) for i, j in zip(at[:-1], at[1:])])
            yield batch, [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())]

    added = T.StructType([T.StructField(name, T.StringType()), T.StructField(score, T.DoubleType())])
    return texts.extend(df, added, work), name, score


def predictions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    network = train(sample(docs, doc_id, text, lang))
    narrow = texts.narrow(docs, doc_id, text).toDF("doc_id", "text")
    found, name, score = with_language(narrow, network)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("lang_pred"), F.col(score).alias("score")
    )
