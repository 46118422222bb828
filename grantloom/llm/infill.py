"""Fill-in-the-middle: texts cut in three and put in another order, and put back again.

Texts are worked on as one buffer of bytes. Their cuts are scanned for (code points to byte
positions); at the byte where a part begins, an array of differences holds the change of the
displacement, and its running sum is the displacement of every byte. One scatter then writes
all outputs. Going back, the marks are scanned for in the outputs, give the displacements of
the outputs' bytes, and one gather reads the texts.

Where a text is cut, and whether, follows from a hash of its id, so a lost task comes to the
same result. ``plain`` texts stay as they are: empty ones, those that hold a mark, and one in
ten by hash. Null text counts as empty and a null id hashes as an empty string; repeated rows
get equal results. Buffers are worked on in blocks of ``BLOCK`` bytes, so a long text costs a
few times its own size and no array of its length in words. Columns whose names clash with the
new ones keep theirs; the new ones are those named in :class:`Names`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import texts

PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = (PLAIN, PSM, SPM)
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Percent of texts that are cut, and of these the percent in the order suffix, prefix, middle.
CUT, SUFFIX_FIRST = 90, 20
BLOCK = 1 << 20
#: The parts of each form in their order: 0 prefix, 1 suffix, 2 middle.
_ORDER = {1: (0, 1, 2), 2: (1, 0, 2)}


class Names(NamedTuple):
    """Columns that :func:`transform` adds."""

    n: str
    form: str
    prefix_chars: str
    middle_chars: str
    output: str


def _checked(marks: tuple[str, str, str]) -> list[bytes]:
    """The marks as bytes. None may hold another, nor end as another begins, so that none arises where parts meet."""
    raw = [m.encode() for m in marks]
    pairs = [(a, b) for i, a in enumerate(raw) for j, b in enumerate(raw) if i != j]
    overlap = any(b in a for a, b in pairs) or any(
        a.endswith(b[:k]) for a, b in [*pairs, *zip(raw, raw)] for k in range(1, min(len(a), len(b)))
    )
    if not all(raw) or overlap:
        raise ValueError(f"marks must not overlap: {marks}")
    return raw


def _find(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Places of a mark in a buffer."""
    found = []
    for a in range(0, len(data), BLOCK):
        at = a + np.flatnonzero(data[a : a + BLOCK] == mark[0])
        at = at[at <= len(data) - len(mark)]
        for i, c in enumerate(mark[1:], 1):
            at = at[data[at + i] == c]
        found.append(at)
    return np.concatenate([np.zeros(0, np.int64), *found])


def _inside(at: np.ndarray, size: int, offsets: np.ndarray) -> np.ndarray:
    """The text of each place, for those that do not run into the next text; else -1."""
    owner = np.searchsorted(offsets, at, "right") - 1
    return np.where(at + size <= offsets[owner + 1], owner, -1)


def _leads(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(code points before, their first bytes)`` of one block after the other."""
    before = 0
    for a in range(0, len(data), BLOCK):
        lead = a + np.flatnonzero((data[a : a + BLOCK] & 0xC0) != 0x80)
        yield before, lead
        before += len(lead)


def _points_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points in front of byte positions (ascending)."""
    out = np.zeros(len(at), np.int64)
    for _, lead in _leads(data):
        out += np.searchsorted(lead, at)
    return out


def _bytes_of(data: np.ndarray, points: np.ndarray) -> np.ndarray:
    """First bytes of code points, by number in the buffer (ascending); the end for one beyond the last."""
    out = np.full(len(points), len(data), np.int64)
    for before, lead in _leads(data):
        a, b = np.searchsorted(points, [before, before + len(lead)])
        out[a:b] = lead[points[a:b] - before]
    return out


def _blocks(size: int, places: np.ndarray, steps: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(first, end, displacement)`` of blocks of bytes: the running sum of steps at places (ascending)."""
    carry = 0
    for a in range(0, size, BLOCK):
        b = min(size, a + BLOCK)
        i, j = np.searchsorted(places, [a, b])
        change = np.zeros(b - a, np.int64)
        np.add.at(change, places[i:j] - a, steps[i:j])
        shift = carry + np.cumsum(change)
        carry = int(shift[-1])
        yield a, b, shift


def _steps(begins: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences of displacement where parts begin (in order; an empty part leaves no trace)."""
    return begins, np.diff(shifts, prepend=0)


def arrange(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, cuts: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Outputs and their offsets. ``cuts`` are the two byte positions in the buffer at which each text is cut."""
    begin, end = offsets[:-1], offsets[1:]
    whole = form == 0
    first, second = np.where(whole, end, cuts[:, 0]), np.where(whole, end, cuts[:, 1])
    part_at = np.stack([begin, second, first], axis=1)  # prefix, suffix, middle
    part_size = np.stack([first - begin, end - second, second - first], axis=1)
    mark_size = np.array([len(m) for m in marks])
    sizes = end - begin + np.where(whole, 0, mark_size.sum())
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    to = np.zeros_like(part_at)  # where each part goes
    to[:, 0] = out_offsets[:-1]
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for kind, order in _ORDER.items():
        rows = np.flatnonzero(form == kind)
        at = out_offsets[:-1][rows].copy()
        for p in order:
            for i, c in enumerate(marks[p]):
                out[at + i] = c
            at += mark_size[p]
            to[rows, p] = at
            at += part_size[rows, p]
    # a whole text is all prefix: its other parts are empty and lie at its end
    to[whole, 1] = to[whole, 2] = (to[:, 0] + part_size[:, 0])[whole]
    in_order = [0, 2, 1]  # as the parts lie in the text
    places, steps = _steps(part_at[:, in_order].ravel(), (to - part_at)[:, in_order].ravel())
    for a, b, shift in _blocks(len(data), places, steps):
        out[np.arange(a, b) + shift] = data[a:b]
    return out, out_offsets


def rearrange(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, marks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs, and their offsets. A cut text whose marks are not all there once raises an error."""
    n = len(form)
    begin, end = offsets[:-1], offsets[1:]
    mark_size = np.array([len(m) for m in marks])
    mark_at = np.tile(end[:, None], (1, 3))
    cut = np.flatnonzero(form != 0)
    for p, mark in enumerate(marks):
        at = _find(data, mark)
        owner = _inside(at, len(mark), offsets)
        good = (owner >= 0) & (form[owner] != 0)
        at, owner = at[good], owner[good]
        if len(at) != len(cut) or (owner != cut).any():
            raise ValueError("an output does not hold each mark once")
        mark_at[owner, p] = at
    part_at = mark_at + np.where(form != 0, 1, 0)[:, None] * mark_size
    stop = np.tile(end[:, None], (1, 3))
    for kind, order in _ORDER.items():
        rows = form == kind
        for here, after in zip(order[:-1], order[1:]):
            stop[rows, here] = mark_at[rows, after]
    part_at[form == 0, 0] = begin[form == 0]
    part_size = stop - part_at
    sizes = part_size.sum(axis=1)
    back_offsets = np.concatenate([[0], np.cumsum(sizes)])
    in_order = [0, 2, 1]
    to = np.zeros((n, 3), np.int64)
    at = back_offsets[:-1].copy()
    for p in in_order:
        to[:, p] = at
        at += part_size[:, p]
    # where each byte of a text is found in the output
    places, steps = _steps(to[:, in_order].ravel(), (part_at - to)[:, in_order].ravel())
    out = np.empty(int(back_offsets[-1]), np.uint8)
    for a, b, shift in _blocks(len(out), places, steps):
        out[a:b] = data[np.arange(a, b) + shift]
    return out, back_offsets


def _draws(doc_id: str) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from an id."""
    digest = hashlib.sha256(f"1:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def _text(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def transform(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = MARKS,
) -> tuple[DataFrame, Names]:
    """``df`` with length, form, sizes of prefix and middle (null where plain) and output, and their names."""
    raw_marks = _checked(marks)
    taken, names = list(df.columns), []
    for field in Names._fields:
        names.append(texts.fresh(field, taken))
        taken.append(names[-1])
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())

    def work(batches):
        for batch in batches:
            ids = batch.column(doc_id).cast(pa.string()).to_pylist()
            for a, b, raw, offsets in texts.documents(batch, text):
                data = np.frombuffer(raw, np.uint8)
                before = _points_before(data, offsets)
                n = np.diff(before)
                h = np.array([_draws(ids[i] or "") for i in range(a, b)], np.int64).reshape(-1, 4)
                ends = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
                form = np.where((n == 0) | (h[:, 2] % 100 >= cut), 0, np.where(h[:, 3] % 100 < suffix_first, 2, 1))
                for mark in raw_marks:
                    owner = _inside(_find(data, mark), len(mark), offsets)
                    form[owner[owner >= 0]] = 0
                cuts = _bytes_of(data, (before[:-1, None] + ends).ravel()).reshape(-1, 2)
                cuts = np.minimum(cuts, offsets[1:, None])
                out, out_offsets = arrange(data, offsets, form, cuts, raw_marks)
                plain = form == 0
                yield (
                    batch.slice(a, b - a),
                    [
                        pa.array(n),
                        pa.array([FORMS[k] for k in form.tolist()], pa.string()),
                        pa.array(ends[:, 0], mask=plain),
                        pa.array(ends[:, 1] - ends[:, 0], mask=plain),
                        _text(out, out_offsets),
                    ],
                )

    return texts.extend(df, T.StructType([T.StructField(*f) for f in zip(names, kinds)]), work), Names(*names)


def restore(
    df: DataFrame, output: str = "output", form: str = "form", name: str = "restored", marks: tuple[str, str, str] = MARKS
) -> tuple[DataFrame, str]:
    """``df`` with the text of each output, and the name of that column. Null outputs give empty texts; a null form counts as plain."""
    raw_marks = _checked(marks)
    name = texts.fresh(name, df.columns)

    def work(batches):
        for batch in batches:
            kinds = np.array([FORMS.index(f or PLAIN) for f in batch.column(form).to_pylist()], np.int64)
            for a, b, raw, offsets in texts.documents(batch, output):
                back, at = rearrange(np.frombuffer(raw, np.uint8), offsets, kinds[a:b], raw_marks)
                yield batch.slice(a, b - a), [_text(back, at)]

    return texts.extend(df, T.StructType([T.StructField(name, T.StringType())]), work), name
