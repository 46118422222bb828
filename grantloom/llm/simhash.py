"""SimHash fingerprints, and groups of texts whose fingerprints differ in few bits.

A fingerprint has 64 bits, one for each bit of the XXH64 of a text's shingles. Two that differ
in at most three bits agree on at least three of six blocks (pigeonhole), so each is filed
under the 20 triples of its blocks, and only those that meet in a file are compared. Files
hold different fingerprints only: copies have been merged before. A file is read in sorted
order by one task, which walks it breadth first and gives back a spanning forest instead of
all pairs. Files over ``chunk`` fingerprints are passed on in chunks, and every two chunks are
walked by a task of their own, so no task holds more than two chunks, and no link is lost.

Null and empty texts have fingerprint zero and link like any other. Repeated rows come back
row by row. A null id never names a component; a group without any id has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared, texts
from .components import components

WORDS, SEED, BITS = 3, 42, 3
#: Widths of the blocks; any three of them agree on 31 to 33 bits.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Different fingerprints of one file that a task walks at once.
CHUNK = 4096


def fingerprint(text: bytes) -> int:
    """Unsigned fingerprint of one text."""
    return int(_fold(_hashes(text), np.zeros(1, np.int64))[0]) if text.split() else 0


def _hashes(text: bytes, width: int = WORDS) -> np.ndarray:
    words = text.lower().split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    hashed = xxhash.xxh64_intdigest
    spans = zip(begins[: 1 - width].tolist(), ends[width - 1 :].tolist())
    return np.array([hashed(joined[a:b], SEED) for a, b in spans], np.uint64)


def _fold(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Fingerprints of texts whose hashes begin at ``at`` (none is empty)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    sizes = np.diff(np.append(at, len(hashes)))
    return np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each text as a signed long."""
    name = texts.fresh(name, df.columns)

    def work(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            held, rows, size = [], [], 0

            def settle():
                if held:
                    sizes = np.fromiter(map(len, held), np.int64, len(held))
                    out[rows] = _fold(np.concatenate(held), np.cumsum(sizes) - sizes)

            for row, text_ in enumerate(texts.each_text(batch, text)):
                hashes = _hashes(text_)
                if len(hashes):
                    held.append(hashes)
                    rows.append(row)
                    size += len(hashes)
                if size > 200_000:
                    settle()
                    held, rows, size = [], [], 0
            settle()
            yield batch, [pa.array(out.view(np.int64))]

    return texts.extend(df, T.StructType([T.StructField(name, T.LongType())]), work)


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _files(fingerprint: Column) -> Column:
    """The 20 files of a fingerprint: the number of the triple above, its bits below."""
    starts = np.cumsum([0, *BLOCKS])
    parts = [
        F.shiftrightunsigned(fingerprint, int(starts[i])).bitwiseAND(F.lit((1 << BLOCKS[i]) - 1))
        for i in range(len(BLOCKS))
    ]
    files = []
    for number, triple in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - BITS)):
        key = F.lit(number).cast("long")
        for i in triple:
            key = F.shiftleft(key, BLOCKS[i]).bitwiseOR(parts[i])
        files.append(key)
    return F.array(*files)


def forest(prints: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Edges ``(i, j)`` of trees that span what is linked among different fingerprints."""
    left, edges, queue = np.arange(len(prints)), [], []
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
        i = queue.pop()
        near = np.bitwise_count(prints[left] ^ prints[i]) <= bits
        if near.any():
            found = left[near].tolist()
            edges += [(i, j) for j in found]
            queue += found
            left = left[~near]
    return edges


_LINK = T.StructType([T.StructField(n, T.LongType()) for n in ("u", "v", "file", "chunk")])


def _walk(groups: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    u: list[np.ndarray] = []
    v: list[np.ndarray] = []
    for _, prints in groups:
        edges = np.array(forest(prints.view(np.uint64)), np.int64).reshape(-1, 2)
        u.append(prints[edges[:, 0]])
        v.append(prints[edges[:, 1]])
        if sum(map(len, u)) > 100_000:
            yield _links(u, v)
            u, v = [], []
    if u:
        yield _links(u, v)


def _links(u: list[np.ndarray], v: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(u), np.concatenate(v)
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, none], names=_LINK.names)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[tuple[tuple, np.ndarray, int, bool]]:
    """``(key, fingerprints, chunk, whether it is all)`` of sorted rows, in chunks of ``most``."""
    key, held, chunk = None, np.zeros(0, np.int64), 0
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in keys]
        prints = batch.column("print").to_numpy()
        change = np.zeros(len(prints), bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), len(prints)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            here = tuple(int(c[a]) for c in columns)
            if here != key:
                if len(held):
                    yield key, held, chunk, chunk == 0
                key, held, chunk = here, np.zeros(0, np.int64), 0
            held = np.concatenate([held, prints[a:b]]) if len(held) else prints[a:b]
            while len(held) > most:
                yield key, held[:most], chunk, False
                held, chunk = held[most:], chunk + 1
    if len(held):
        yield key, held, chunk, chunk == 0


def links(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(u, v)``: edges that connect the different fingerprints ``print`` just as all links would."""
    filed = prints.select(F.explode(_files(F.col("print"))).alias("file"), "print")
    dealt = filed.repartition(F.col("file")).sortWithinPartitions("file", "print")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large: list[pa.RecordBatch] = []

        def small() -> Iterator[tuple[int, np.ndarray]]:
            for key, found, number, whole in _runs(batches, ["file"], chunk):
                if whole:
                    if len(found) > 1:
                        yield key[0], found
                else:
                    n = len(found)
                    none = pa.nulls(n, pa.int64())
                    parts = [pa.array(found), none, pa.array(np.full(n, key[0])), pa.array(np.full(n, number))]
                    large.append(pa.RecordBatch.from_arrays(parts, names=_LINK.names))

        for batch in _walk(small()):
            yield batch
            while large:
                yield large.pop()
        while large:
            yield large.pop()

    found = shared.keep(dealt.mapInArrow(first, _LINK))
    linked = found.filter("file is null").select("u", "v")

    # every two chunks of a large file meet in a task; the number of chunks of a file is few
    large = found.filter("file is not null").select("file", "chunk", F.col("u").alias("print"))
    sizes = large.groupBy("file").agg(F.max("chunk").alias("last"))
    pairs = (
        large.join(sizes, "file")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .filter("other != chunk")
        .select("file", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "print")
    )

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _walk((k, p) for k, p, _, _ in _runs(batches, ["file", "i", "j"], 2 * chunk))

    met = pairs.repartition("file", "i", "j").sortWithinPartitions("file", "i", "j", "print")
    return linked.unionByName(met.mapInArrow(second, _LINK).select("u", "v"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``doc_id``, ``print`` (signed fingerprint) and ``component_id`` of every row."""
    docs = shared.keep(
        with_fingerprint(texts.narrow(df, doc_id, text), text, "print").select(F.col(doc_id).alias("doc_id"), "print")
    )
    nodes = shared.keep(docs.groupBy("print").agg(F.min("doc_id").alias("least")))
    grouped = shared.keep(components(links(nodes.select("print"), chunk)))
    # a root's group takes the least id of all its fingerprints
    rooted = nodes.join(grouped.withColumnRenamed("node", "print"), "print")
    least = rooted.groupBy("root").agg(F.min("least").alias("group_least"))
    named = rooted.select("print", "root").join(least, "root").select("print", "group_least")
    known = shared.keep(
        nodes.join(named, "print", "left").select("print", F.coalesce("group_least", "least").alias("component_id"))
    )
    return docs.join(known, "print").select("doc_id", "print", "component_id")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stand for their group of near duplicates: those whose id is its least.

    Rows that share an id count as one document; one of them stays. In a group without ids one row stays.
    """
    found = near_duplicates(df, doc_id, text)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count("*").alias("rows"))
    kept = shared.keep(kept)
    one, many = (texts.fresh(n, df.columns) for n in ("_single", "_many"))

    def of(condition: str, name: str) -> DataFrame:
        ids = kept.filter(condition).select(F.col("doc_id").alias(name))
        return df.join(ids, df[f"`{doc_id}`"].eqNullSafe(F.col(name)), "left_semi")

    return of("rows = 1", one).unionByName(of("rows > 1", many).dropDuplicates([doc_id]))
