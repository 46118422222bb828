"""Whole texts inside Arrow tasks, a few megabytes at a time.

Operators that read texts run in ``mapInArrow``: Spark deals the rows out, a task turns each
batch into one byte buffer with offsets and works on slices of bounded size. A row is never
cut for good: what an operator splits it also puts together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of text that one step inside a task works on at once.
SLICE_BYTES = 4 << 20


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row comes alone."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(n, max(stop, row + 1))
        yield row, stop
        row = stop


def documents(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of slices of a batch's texts."""
    raw, offsets = buffers(batch.column(text))
    for a, b in row_slices(offsets, limit):
        yield a, b, raw[offsets[a] : offsets[b]].tobytes(), offsets[a : b + 1] - offsets[a]


def each_text(batch: pa.RecordBatch, text: str) -> Iterator[bytes]:
    """Every text of a batch as UTF-8, null as empty, one copy at a time."""
    raw, offsets = buffers(batch.column(text))
    view = memoryview(raw)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield bytes(view[a:b])


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores in front until no column (in any case) has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def extend(
    df: DataFrame, added: T.StructType, work: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list]]]
) -> DataFrame:
    """``df`` with more columns, in ``mapInArrow``.

    ``work`` gets the batches and yields each batch (or some of its rows) with the arrays of
    the added columns. Names must be new; :func:`fresh` finds such.
    """
    schema = T.StructType([*df.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in work(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *added.names])

    return df.mapInArrow(run, schema)


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra ones, whatever their names, play no part."""
    return df.select(*[df[f"`{c}`"] for c in columns])
